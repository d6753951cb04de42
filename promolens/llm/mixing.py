"""Mixing to target weights with soft domain membership.

A softmax classifier over hashed words, fitted on a bounded sample of every domain
of a labelled table, gives every document a posterior over the domains.  The rates (how often
a document is to be used) are the nonnegative least-squares solution nearest to
using every document once:

    minimise  sum of tokens * (rate - 1)^2
    so that   sum of rate * tokens * posterior  comes closest to the target tokens

It is found by lazily projected gradient steps, preconditioned with the domains'
Gram matrix.  All that a step needs of the past is one number per domain, so a
step is one distributed aggregation over a narrow table.
"""

from __future__ import annotations

import re
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_of, kept_by_worker, let_go, received, send, ship, small_batches, written
from .wordpiece import WORD, Automaton, byte_vocabulary

DIM = 1 << 18
#: About as many labelled documents of the fit, chosen by a hash of their ids in equal
#: numbers from every domain, and about as many at least from each (or all it has).
FIT_ROWS, LEAST_ROWS = 3000, 20
#: A word needs as many texts of the sample to count, or half of a small domain's.
SUPPORT = 5
#: Target weights are the present shares to this power, unless they are given.
TEMPERATURE = 0.7
#: The target total is this many times the least total that cuts no domain.
MARGIN = 1.02
#: Steps end when every domain is this close to its target, as a share of it.
CLOSE, MOST_STEPS = 1e-6, 200
MEMO_WORDS = 400_000
LETTERS = re.compile(r"[^\W\d_]+")


def slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8")) % DIM


class WordSlots(dict):
    """Hashed places of the words seen so far: of their letters, in lower case.

    Most words have one place. A word without letters has -1, and one with several
    stretches of letters a smaller number, by which ``several`` has their places.
    """

    def __init__(self):
        super().__init__()
        self.several: dict[int, list[int]] = {}

    def place(self, word: str) -> int:
        places = [slot(w) for w in LETTERS.findall(word.lower())]
        if len(places) == 1:
            return places[0]
        if not places:
            return -1
        found = -2 - len(self.several)
        self.several[found] = places
        return found

    def __missing__(self, word: str) -> int:
        found = self[word] = self.place(word)
        return found


def word_slots(words: list[str], slots: WordSlots) -> np.ndarray:
    """Distinct hashed places of the words of a text."""
    distinct = set(words)
    if len(slots) + len(distinct) > MEMO_WORDS:  # forget between texts, not within one
        slots.clear()
        slots.several.clear()
    found = set(map(slots.__getitem__, distinct))
    found.discard(-1)
    if found and min(found) < 0:
        found = {p for f in found for p in (slots.several[f] if f < 0 else (f,))}
    return np.fromiter(found, np.int64, len(found))


class KnownWords(dict):
    """Numbers of the words seen so far; by number, their tokens and hashed places.

    One look-up per word of a text serves its token count and its places; the rest is
    array work.
    """

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton, self.slots = automaton, WordSlots()
        self.tokens, self.places = np.zeros(MEMO_WORDS, np.int32), np.zeros(MEMO_WORDS, np.int64)

    def __missing__(self, word: str) -> int:
        number = len(self)
        if number == len(self.tokens):  # a single text of more words
            self.tokens, self.places = (np.resize(a, 2 * number) for a in (self.tokens, self.places))
        self.tokens[number] = self.automaton.count(b" " + word.encode("utf-8"))
        self.places[number] = self.slots.place(word)
        self[word] = number
        return number

    def read(self, text: str) -> tuple[int, np.ndarray]:
        """Tokens of a text, and the distinct hashed places of its words in order."""
        words = WORD.findall(text)
        if len(self) + len(words) > MEMO_WORDS:  # forget between texts, not within one
            self.clear()
            self.slots.several.clear()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        places = self.places[numbers]
        places.sort()
        new = np.ones(len(places), bool)
        np.not_equal(places[1:], places[:-1], out=new[1:])
        places = places[new]
        several = [self.slots.several[p] for p in places[places < -1].tolist()]
        places = places[places >= 0]
        if several:
            places = np.unique(np.concatenate([places, *several]))
        return int(self.tokens[numbers].sum()), places


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class DomainModel:
    """Word weights (places x domains), log priors and the domains' names."""

    weights: np.ndarray
    prior: np.ndarray
    domains: list[str]

    def posterior(self, slots: np.ndarray) -> np.ndarray:
        """Softmax of the mean weights of the distinct words; the priors without any."""
        mean = self.weights[slots].mean(axis=0) if len(slots) else 0.0
        return softmax(self.prior + mean)


def fit(slots: list[np.ndarray], labels: list[str], counts: dict[str, int],
        rounds: int = 150, rate: float = 0.5) -> DomainModel:
    """Maximum likelihood by Adam steps over the whole sample.

    ``counts`` has all domains, with their numbers of labelled documents.  The
    words are fitted beside the domains' shares of the sample; the model's priors
    are their shares of all labelled documents.  A domain without a text in the
    sample has prior 0.
    """
    domains = sorted(counts)
    y = np.array([domains.index(v) for v in labels])
    n, k = len(y), len(domains)
    lens = np.array([len(s) for s in slots])
    flat, owner = np.concatenate([*slots, np.empty(0, np.int64)]).astype(np.int64), np.repeat(np.arange(n), lens)
    own = np.bincount(y, minlength=k)
    frequent = np.bincount(flat, minlength=DIM) >= min(SUPPORT, n / k)
    for j in np.flatnonzero(own):
        frequent |= np.bincount(flat[y[owner] == j], minlength=DIM) >= min(SUPPORT, own[j] / 2)
    weights = np.zeros((DIM, k), np.float32)
    inside = frequent[flat]
    used, cols = np.unique(flat[inside], return_inverse=True)
    owner = owner[inside]
    scale = 1.0 / np.maximum(lens, 1)
    with np.errstate(divide="ignore"):
        prior = np.log(own / n)
    w = np.zeros((len(used), k))
    first, second = np.zeros_like(w), np.zeros_like(w)
    hot = np.eye(k)[y]
    for t in range(1, rounds + 1):
        s = np.stack([np.bincount(owner, weights=w[cols, j], minlength=n) for j in range(k)], axis=1)
        d = (softmax(prior + s * scale[:, None]) - hot) * scale[:, None] / n
        g = np.stack([np.bincount(cols, weights=d[owner, j], minlength=len(used)) for j in range(k)], axis=1)
        g = g + 1e-7 * w
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        w -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-10)
    weights[used] = w
    whole = np.where(own > 0, np.maximum([counts[d] for d in domains], 1), 0)
    with np.errstate(divide="ignore"):
        return DomainModel(weights, np.log(whole / whole.sum()), domains)


def labelled_sample(docs: DataFrame, labelled: DataFrame, limit: int) -> tuple[list, list, dict[str, int]]:
    """Hashed words and domains of a sample of every domain, and the number of
    documents of all domains of the labelled table (0 if none is in ``docs``)."""
    spark = docs.sparkSession
    here = docs.where("doc_id IS NOT NULL").select("doc_id").distinct().withColumn("here", F.lit(1))
    pairs = written(columns_of(labelled, "doc_id", "domain").where("domain IS NOT NULL").distinct()
                    .join(here, "doc_id", "left"))
    counts = {r.domain: r.n for r in pairs.groupBy("domain").agg(F.count("here").alias("n")).collect()}
    if not any(counts.values()):
        return [], [], counts
    each = max(LEAST_ROWS, limit // len(counts))
    bounds = spark.createDataFrame([(d, min(1.0, each / n)) for d, n in counts.items() if n],
                                   "domain string, bound double")
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    few = (pairs.where("here IS NOT NULL").join(F.broadcast(bounds), "domain")
           .where(spread < F.col("bound")).select("doc_id", "domain"))  # bounded, so it may be broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        slots = WordSlots()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("domain"), pa.array([np.sort(word_slots(WORD.findall(t or ""), slots))
                                                   for t in batch.column("text").to_pylist()],
                                                  pa.list_(pa.int64()))], ["domain", "slots"])
    rows = (docs.join(F.broadcast(few), "doc_id").select("domain", "text")
            .mapInArrow(run, "domain string, slots array<long>").collect())
    distinct = sorted({(r.domain, tuple(r.slots)) for r in rows})  # copies count once
    return [np.array(s, np.int64) for _, s in distinct], [d for d, _ in distinct], counts


def posteriors(docs: DataFrame, model: DomainModel, vocabulary_path: str) -> DataFrame:
    """``doc_id, n_tokens, posterior`` of every document."""
    spark = docs.sparkSession
    sent_model, sent_automaton = send(spark, model), send(spark, Automaton(byte_vocabulary(vocabulary_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(sent_model, DomainModel)
        known = kept_by_worker(f"mixing words {vocabulary_path}",
                               lambda: KnownWords(received(sent_automaton, Automaton)))
        for batch in batches:
            tokens, posteriors = [], []
            for text in batch.column("text").to_pylist():
                count, places = known.read(text or "")
                tokens.append(count)
                posteriors.append(model.posterior(places).astype(float))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tokens, pa.int64()),
                 pa.array(posteriors, pa.list_(pa.float64()))], ["doc_id", "n_tokens", "posterior"])
    return docs.mapInArrow(run, "doc_id long, n_tokens long, posterior array<double>")


def rate_column(moves: np.ndarray, least: float) -> Column:
    """Rate of a document: 1 less its posterior times the moves, projected."""
    step = sum((F.get("posterior", F.lit(d)) * F.lit(float(v)) for d, v in enumerate(moves)), F.lit(0.0))
    return F.greatest(F.lit(float(least)), F.lit(1.0) - step)


def domain_totals(soft: DataFrame, rate: Column, k: int) -> np.ndarray:
    """Expected tokens of every domain under the rates."""
    mass = rate * F.col("n_tokens")
    row = soft.agg(*[F.coalesce(F.sum(mass * F.get("posterior", F.lit(d))), F.lit(0.0)) for d in range(k)]).first()
    return np.array(row, dtype=float)


def gram(soft: DataFrame, k: int) -> np.ndarray:
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = soft.agg(*[F.coalesce(F.sum(F.col("n_tokens") * F.get("posterior", F.lit(i))
                                      * F.get("posterior", F.lit(j))), F.lit(0.0)) for i, j in pairs]).first()
    out = np.zeros((k, k))
    for (i, j), v in zip(pairs, row, strict=True):
        out[i, j] = out[j, i] = v
    return out


def target_totals(have: np.ndarray, domains: list[str], weights: dict[str, float] | None,
                  total: float | None) -> np.ndarray:
    """Target tokens of every domain."""
    share = (np.array([max(weights.get(d, 0.0), 0.0) for d in domains]) if weights is not None
             else (have / max(have.sum(), 1e-12)) ** TEMPERATURE)
    share = share / share.sum() if share.sum() > 0 else share
    if total is None:
        some = share > 0
        total = MARGIN * float((have[some] / share[some]).max()) if some.any() else 0.0
    return share * total


def solve(soft: DataFrame, targets: np.ndarray, least: float) -> np.ndarray:
    """The moves (one number per domain) of the projected gradient steps.

    Warns where the steps end before every domain is close to its target, be it
    that targets are out of reach or that more steps were needed."""
    k = len(targets)
    moves = np.zeros(k)
    pairs = gram(soft, k)
    met = np.diag(pairs) > 0  # no rate brings tokens to a domain without documents
    inverse = np.linalg.pinv(pairs, rcond=1e-10)
    best, best_moves = np.inf, moves
    for _ in range(MOST_STEPS):
        miss = domain_totals(soft, rate_column(moves, least), k) - targets
        worst = float(np.max((np.abs(miss) / np.maximum(targets, 1.0))[met], initial=0.0))
        if worst < best:
            best, best_moves = worst, moves
        if worst <= CLOSE:
            break
        moves = moves + inverse @ miss
    if best > CLOSE:
        warnings.warn(f"after {MOST_STEPS} steps a domain is {best:.2g} of its target off", stacklevel=2)
    return best_moves


def mix(docs: DataFrame, labelled: DataFrame, vocabulary_path: str,
        weights: dict[str, float] | None = None, total: float | None = None,
        least: float = 0.0, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, domain, posterior, rate``.

    ``labelled`` has ``doc_id`` and a text ``domain``; a document may have several.
    The domains are all of this table and of ``weights``.  ``weights`` are the target
    shares of the domains' tokens (domains left out: 0); by default the present
    shares to the power ``TEMPERATURE``.  ``total`` is the target number of
    tokens; by default the least that cuts no domain, times ``MARGIN``.  ``least``
    is the smallest rate allowed.  ``posterior`` is in the order of the sorted
    domains; ``domain`` is the likeliest, ties going to the first.  Where targets
    cannot be met (a domain without documents, or too high a ``least``) the rates
    come as close as the steps got; the other domains' targets stay the same.  Null and empty texts have the priors and no
    tokens.  Without labelled documents there is one unnamed domain and every
    rate is 1.  Repeated rows and null ids give a row each; an empty table gives
    none; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    base = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    slots, names, counts = labelled_sample(base, labelled, fit_rows)
    counts = dict.fromkeys(weights or (), 0) | counts
    model = fit(slots, names, counts) if names else DomainModel(np.zeros((DIM, 1), np.float32), np.zeros(1), [""])
    soft = written(posteriors(base, model, vocabulary_path))
    k = len(model.domains)
    if names:
        have = domain_totals(soft, F.lit(1.0), k)
        moves = solve(soft, target_totals(have, model.domains, weights, total), least)
    else:
        moves = np.zeros(k)
    names_column = F.array(*[F.lit(d) for d in model.domains])
    return soft.select(
        "doc_id", "n_tokens",
        F.get(names_column, F.array_position("posterior", F.array_max("posterior")).cast("int") - 1).alias("domain"),
        "posterior", rate_column(moves, least).alias("rate"))


def times_used(rate: Column, *key: Column) -> Column:
    """Whole number of uses whose mean over documents is the rate: the floor, and
    one more by a hash of the key."""
    spread = F.pmod(F.xxhash64(F.lit("uses"), *key), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (spread < rate - F.floor(rate)).cast("int")).cast("int")


ship(__name__)
