"""Ordinal quality classifier: cumulative-link regression on graded ratings.

All grades share one weight vector over hashed text features; ordered thresholds
cut its score into grades.  ``P(grade <= k) = sigmoid(threshold_k - score)``, so
one score per text gives the expected grade and the tail probability by which
texts are selected.  The fit uses a bounded sample of the graded rows; scoring
is one map over all texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_of, let_go, received, removed, send, ship, small_batches, with_plain_names, written

#: Size of the hashed feature space.
DIM = 1 << 18
#: Most graded rows used for the fit, chosen by a hash of their ids.
FIT_ROWS = 10000
#: A feature needs as many graded texts of the sample to get a weight.
SUPPORT = 8
#: and a score statistic (in standard deviations) of at least this.
SCREEN = 4.5
#: Grades: 0 low quality, 1 toxic, 2 good.
GRADES = 3
#: A text is kept when P(highest grade) is at least this.
KEEP_AT = 0.7
#: Distinct words whose weights a worker remembers before it starts anew.
MEMO_WORDS = 400_000

WORD = re.compile(r"[^\W\d_]+")


def grade_of_labels(quality: Column, toxic: Column) -> Column:
    """0: low quality, 1: toxic, 2: neither; null where both labels are null."""
    return (F.when(quality.isNull() & toxic.isNull(), F.lit(None))
            .when(F.coalesce(quality, F.lit(1)) == 0, 0)
            .when(F.coalesce(toxic, F.lit(0)) == 1, 1).otherwise(2)).cast("int")


def slot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8")) % DIM


#: A share counts as one feature for each of these levels that it reaches.
LEVELS = (0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
SIGNS = re.compile(r"[^\w\s]{2,}")
LONE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")


def shape_features(text: str) -> list[str]:
    """The levels that shares describing the form of a text reach."""
    tokens = text.split()
    n = len(tokens) or 1
    shares = {
        "caps": sum(map(str.isupper, tokens)) / n,
        "lone": len(LONE.findall(text)) / n,
        "signs": len(SIGNS.findall(text)) / n,
        "again": sum(map(str.__eq__, tokens, tokens[1:])) / n,
        "distinct": len(set(tokens)) / n,
    }
    return [f"#{k}:{i}" for k, v in shares.items() for i, at in enumerate(LEVELS) if v >= at]


def word_slots(word: str) -> tuple[int, ...]:
    """Hashed features of a distinct word: itself and its beginnings."""
    return tuple(slot(f) for f in (word, "^" + word[:4], "^" + word[:5]))


class WordSlots(dict):
    """Hashed features of the words seen so far."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MEMO_WORDS:
            self.clear()
        found = self[word] = word_slots(word)
        return found


def text_slots(text: str | None, memo: dict) -> list[int]:
    """Hashed features of a text: of its distinct words and of its form."""
    text = text or ""
    words = set(WORD.findall(text.lower()))
    return sorted(i for w in words for i in memo[w]) + [slot(f) for f in shape_features(text)]


FORM_SLOTS = [slot(f"#{k}:{i}") for k in ("caps", "lone", "signs", "again", "distinct")
              for i in range(len(LEVELS))]


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every threshold k, one row per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - np.asarray(score)[:, None], -60, 60)))


def fit(slots: list[np.ndarray], grades: list[int], n_grades: int = GRADES, rounds: int = 300,
        rate: float = 0.1, decay: float = 1e-3, useful: np.ndarray | None = None) -> OrdinalModel:
    """Maximum likelihood with weight decay, by Adam steps over the whole sample.

    ``slots`` hold the useful features alone where these are given; else those that
    ``useful_slots`` finds in the sample carry weight.
    """
    k = n_grades - 1
    y, n = np.asarray(grades), len(grades)
    if useful is None:
        times, texts = np.zeros((n_grades, DIM)), np.zeros(DIM)
        for s, g in zip(slots, grades, strict=True):
            np.add.at(times[g], s, 1)
            texts[np.unique(s)] += 1
        useful = useful_slots(times, texts, np.bincount(y, minlength=n_grades))
    flat = np.concatenate([s[useful[s]] for s in slots]).astype(np.int32)
    owner = np.repeat(np.arange(n, dtype=np.int32), [int(useful[s].sum()) for s in slots])
    used = np.flatnonzero(np.bincount(flat, minlength=DIM))
    cols = np.searchsorted(used, flat).astype(np.int32)
    del flat

    share = np.array([np.clip((y <= j).mean(), 0.01, 0.99) for j in range(k)])
    # thresholds as the first and the logs of the gaps, so that they stay ordered
    start = np.log(share / (1 - share))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    both = np.concatenate([free, np.zeros(len(used))])
    first, second = np.zeros_like(both), np.zeros_like(both)
    for t in range(1, rounds + 1):
        theta, w = ordered(both[:k]), both[k:]
        g, g_theta = gradients(theta, np.bincount(owner, weights=w[cols], minlength=n), y)
        g_free = [g_theta.sum(), *(g_theta[j:].sum() * np.exp(both[j]) for j in range(1, k))]
        slope = np.concatenate([g_free, np.bincount(cols, weights=g[owner], minlength=len(used))]) / n
        slope[k:] += decay * w
        first += 0.1 * (slope - first)
        second += 0.01 * (slope ** 2 - second)
        both = both - rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    full = np.zeros(DIM)
    full[used] = both[k:]
    return OrdinalModel(full, ordered(both[:k]))


def ordered(free: np.ndarray) -> np.ndarray:
    return np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])


def useful_slots(times: np.ndarray, texts: np.ndarray, per_grade: np.ndarray) -> np.ndarray:
    """Which features carry weight: those of ``SUPPORT`` texts or more whose largest score
    statistic, for the splits of the grades, reaches ``SCREEN``.

    ``times``: occurrences by grade and feature; ``texts``: texts that have the feature;
    ``per_grade``: texts of each grade."""
    n_grades, n = len(per_grade), per_grade.sum()
    total = times.sum(axis=0)
    best = np.zeros(DIM)
    for j in range(n_grades - 1):
        mean = per_grade[j + 1:].sum() / n
        gap = times[j + 1:].sum(axis=0) - mean * total
        best = np.maximum(best, np.abs(gap) / np.sqrt(np.maximum(total * mean * (1 - mean), 1e-9)))
    return (texts >= min(SUPPORT, n / n_grades)) & (best >= SCREEN)


def gradients(theta: np.ndarray, s: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the negative log likelihood by each score and by the thresholds."""
    edges = np.concatenate([[-np.inf], theta, [np.inf]])
    a, b = (1 / (1 + np.exp(-np.clip(edges[y + d] - s, -40, 40))) for d in (1, 0))
    p = np.maximum(a - b, 1e-9)
    by_theta = [(-a * (1 - a) / p)[y == j].sum() + (b * (1 - b) / p)[y == j + 1].sum()
                for j in range(len(theta))]
    return 1 - a - b, np.array(by_theta)


def graded_sample(docs: DataFrame, grades: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """``grade, slots`` of at most ``limit`` graded documents (a written table).

    One grade per document (the lowest of repeated ones); the sample is the
    smallest by a hash of the id, so it does not depend on the row order.  Copies
    count once.
    """
    few = (columns_of(grades, "doc_id", "grade").where("doc_id IS NOT NULL AND grade IS NOT NULL")
           .groupBy("doc_id").agg(F.min("grade").alias("grade"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))  # bounded, so it may be broadcast
    texts = columns_of(docs, "doc_id", "text").where("doc_id IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        memo = WordSlots()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"),
                 pa.array([np.array(text_slots(t, memo), np.int32).tobytes()
                           for t in batch.column("text").to_pylist()], pa.binary())], ["grade", "slots"])
    rows = texts.join(F.broadcast(few), "doc_id").select("grade", "text").mapInArrow(run, "grade int, slots binary")
    return written(rows.where(F.octet_length("slots") > 0).distinct())


def slot_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(occurrences by grade and feature, texts by feature, texts by grade), counted by the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: dict[int, np.ndarray] = {}
        texts: dict[int, np.ndarray] = {}
        for batch in batches:
            for grade, data in zip(batch.column("grade").to_pylist(), batch.column("slots").to_pylist(), strict=True):
                found = np.frombuffer(data, np.int32)
                if grade not in times:
                    times[grade], texts[grade] = np.zeros(DIM, np.int64), np.zeros(DIM, np.int64)
                np.add.at(times[grade], found, 1)
                texts[grade][np.unique(found)] += 1
        for grade in times:
            hit = np.flatnonzero(times[grade])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(hit), grade), pa.int32()), pa.array(hit, pa.int32()),
                 pa.array(times[grade][hit], pa.int64()), pa.array(texts[grade][hit], pa.int64())],
                ["grade", "slot", "times", "texts"])
    table = (sample.mapInArrow(run, "grade int, slot int, times long, texts long")
             .groupBy("grade", "slot").agg(F.sum("times").alias("times"), F.sum("texts").alias("texts")).toArrow())
    per_grade = dict(sample.groupBy("grade").count().collect())
    n_grades = max([GRADES, *(g + 1 for g in per_grade)])
    grade, slots = table["grade"].to_numpy(), table["slot"].to_numpy()
    times, texts = np.zeros((n_grades, DIM)), np.zeros(DIM)
    times[grade, slots] = table["times"].to_numpy()
    np.add.at(texts, slots, table["texts"].to_numpy())
    return times, texts, np.array([per_grade.get(g, 0) for g in range(n_grades)])


def screened(sample: DataFrame, useful: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """(useful features, grades) of the sample's texts: only these come to the driver."""
    shared = sample.sparkSession.sparkContext.broadcast(np.packbits(useful).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        for batch in batches:
            found = [np.frombuffer(s, np.int32) for s in batch.column("slots").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), pa.array([s[good[s]].tobytes() for s in found], pa.binary())],
                ["grade", "slots"])
    table = sample.mapInArrow(run, "grade int, slots binary").toArrow()
    rows = sorted(zip(table["grade"].to_pylist(), table["slots"].to_pylist(), strict=True))
    return [np.frombuffer(s, np.int32) for _, s in rows], [g for g, _ in rows]


class WordWeights(dict):
    """Weights of the words seen so far."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO_WORDS:
            self.clear()
        found = self[word] = float(sum(self.weights[i] for i in word_slots(word)))
        return found


def model_of(docs: DataFrame, grades: DataFrame, fit_rows: int) -> OrdinalModel | None:
    """The fitted model; None without any graded document."""
    small_batches(docs.sparkSession)
    sample = graded_sample(docs, grades, fit_rows)
    times, texts, per_grade = slot_counts(sample)
    if not per_grade.any():
        return None
    useful = useful_slots(times, texts, per_grade)
    del times, texts
    slots, known = screened(sample, useful)
    removed(sample)
    return fit(slots, known, len(per_grade), useful=useful)


def scored(texts: list[str | None], model: OrdinalModel | None, weights: WordWeights | None) -> tuple:
    """(scores, probabilities of the highest grade, expected grades) of some texts."""
    if model is None:
        return [0.0] * len(texts), [None] * len(texts), [None] * len(texts)
    scores = np.array([sum(map(weights.__getitem__, set(WORD.findall(t.lower()))))
                       + sum(model.weights[slot(f)] for f in shape_features(t))
                       for t in (t or "" for t in texts)], dtype=float)
    tails = model.tails(scores)
    return scores, tails[:, -1], tails.sum(axis=1)


def good_documents(docs: DataFrame, grades: DataFrame, keep_at: float = KEEP_AT,
                   fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``quality_scores`` keeps.

    One map: texts are not shuffled.  Rows, nulls and extra columns are passed on
    as they are; ``docs`` needs a column ``text``.
    """
    shared = send(docs.sparkSession, model_of(docs, grades, fit_rows))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model = received(shared, OrdinalModel)
        weights = WordWeights(model.weights) if model else None
        for batch in batches:
            _, good, _ = scored(batch.column(place).to_pylist(), model, weights)
            yield batch.filter(pa.array([g is None or bool(g >= keep_at) for g in good], pa.bool_()))
    plain = with_plain_names(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def quality_scores(docs: DataFrame, grades: DataFrame, keep_at: float = KEEP_AT,
                   fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: ``doc_id, score, expected_grade, p_good, kept``.

    ``grades`` has ``doc_id`` and an integer ``grade`` from 0 on.  ``p_good`` is
    the probability of the highest grade; ``kept`` holds where it is at least
    ``keep_at``.  Null and empty texts score like a text without words.  Without
    any graded document nothing is known: every score is 0, ``p_good`` is null
    and every row is kept.  Repeated rows and null ids give a row each; an empty
    table gives none; other columns are ignored.
    """
    shared = send(docs.sparkSession, model_of(docs, grades, fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model = received(shared, OrdinalModel)
        weights = WordWeights(model.weights) if model else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores, good, expected = scored(texts, model, weights)
            kept = [g is None or g >= keep_at for g in good]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(expected, pa.float64()),
                 pa.array(good, pa.float64()), pa.array(kept, pa.bool_())],
                ["doc_id", "score", "expected_grade", "p_good", "kept"])
    base = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return base.mapInArrow(
        run, "doc_id long, score double, expected_grade double, p_good double, kept boolean")


ship(__name__)
