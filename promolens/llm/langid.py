"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads segments of a text's UTF-8 bytes in both directions, gives
every position a distribution over the languages, and a document gets the mean
over all its positions.  It is trained in numpy by backpropagation through time
on a bounded sample of labelled documents; every byte of every text is read when
languages are predicted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, received, send, ship, small_batches

HIDDEN = 8
#: Bytes of a segment; the state starts anew in each.
SEGMENT = 128
#: Most documents of a language, and segments of a document, in the training sample.
FIT_DOCS, FIT_SEGMENTS = 250, 6
#: Segments that are read at the same time.
LANES = 4096
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """Weights; the first axis of all but the last two is the direction."""

    table: np.ndarray  # 2 x 256 x 3H: what a byte adds to update gate, reset gate, candidate
    turn: np.ndarray   # 2 x H x 3H: what the state adds
    out: np.ndarray    # 2 x H x L
    bias: np.ndarray   # L
    langs: list[str]

    def arrays(self) -> list[np.ndarray]:
        return [self.table, self.turn, self.out, self.bias]


def gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def aligned(segments: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(2 x T x N bytes read forwards and backwards, T x N places of the backward steps).

    Both directions begin with a real byte; what follows a short segment is not used.
    """
    steps = np.arange(segments.shape[1])[:, None]
    places = np.maximum(lengths[None, :] - 1 - steps, 0)
    forward = segments.T
    return np.stack([forward, np.take_along_axis(forward, places, axis=0)]), places


def states(net: Network, read: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (2 x T x N x H) after every step; ``keep`` gets what training needs."""
    _, steps, n = read.shape
    h_size = net.turn.shape[1]
    out = np.empty((2, steps, n, h_size), np.float32)
    h = np.zeros((2, n, h_size), np.float32)
    which = np.arange(2)[:, None]
    for t in range(steps):
        x = net.table[which, read[:, t]]
        u = h @ net.turn
        zr = gate(x[..., :2 * h_size] + u[..., :2 * h_size])
        z, r = zr[..., :h_size], zr[..., h_size:]
        c = np.tanh(x[..., 2 * h_size:] + r * u[..., 2 * h_size:])
        if keep is not None:
            keep.append((h, z, r, c, u[..., 2 * h_size:]))
        h = h + z * (c - h)
        out[:, t] = h
    return out


def position_scores(net: Network, segments: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unnormalised scores of the languages at every position (T x N x L)."""
    read, places = aligned(segments, lengths)
    both = states(net, read)
    back = both[1] @ net.out[1]
    return both[0] @ net.out[0] + np.take_along_axis(back, places[..., None], axis=0) + net.bias


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def loss_slopes(net: Network, segments: np.ndarray, lengths: np.ndarray,
                labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all positions and its derivatives by every weight."""
    read, places = aligned(segments, lengths)
    kept: list = []
    both = states(net, read, kept)
    _, steps, n, h_size = both.shape
    back = np.take_along_axis(both[1], places[..., None], axis=0)
    p = softmax(both[0] @ net.out[0] + back @ net.out[1] + net.bias)
    valid = (np.arange(steps)[:, None] < lengths[None, :]) / lengths.sum()
    loss = float(-(np.log(np.maximum(p[:, np.arange(n), labels], 1e-12)) * valid).sum())
    d = p.copy()
    d[:, np.arange(n), labels] -= 1
    d = (d * valid[..., None]).astype(np.float32)
    d_out = np.stack([np.tensordot(both[0], d, ([0, 1], [0, 1])), np.tensordot(back, d, ([0, 1], [0, 1]))])
    d_bias = d.sum(axis=(0, 1))
    d_state = np.zeros_like(both)
    d_state[0] = d @ net.out[0].T
    # a backward step sees the position it stands for; places of unused steps have no slope
    lane = np.arange(n)[None, :].repeat(steps, 0)
    used = valid > 0
    d_state[1][places[used], lane[used]] = (d @ net.out[1].T)[used]
    d_table, d_turn = np.zeros_like(net.table), np.zeros_like(net.turn)
    dh = np.zeros((2, n, h_size), np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, c, uc = kept[t]
        dh = dh + d_state[:, t]
        dc = dh * z * (1 - c * c)
        dz = dh * (c - h) * z * (1 - z)
        dr = dc * uc * r * (1 - r)
        d_in = np.concatenate([dz, dr, dc], axis=-1)          # slopes by what the byte adds
        d_u = np.concatenate([dz, dr, dc * r], axis=-1)       # and by what the state adds
        for k in range(2):
            np.add.at(d_table[k], read[k, t], d_in[k])
            d_turn[k] += h[k].T @ d_u[k]
        dh = dh * (1 - z) + d_u @ net.turn.transpose(0, 2, 1)
    return loss, [d_table, d_turn, d_out, d_bias]


def train(samples: list[tuple[bytes, str]], rounds: int = 300, batch: int = 96, rate: float = 0.03,
          hidden: int = HIDDEN, seed: int = 7) -> Network | None:
    """A network for the labelled segments (None without any), by Adam steps.

    Languages weigh alike whatever their number of segments.
    """
    samples = sorted((s, k) for s, k in samples if s)
    if not samples:
        return None
    langs = sorted({k for _, k in samples})
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.3, (2, 256, 3 * hidden)).astype(np.float32),
                  rng.normal(0, 0.3, (2, hidden, 3 * hidden)).astype(np.float32),
                  rng.normal(0, 0.3, (2, hidden, len(langs))).astype(np.float32),
                  np.zeros(len(langs), np.float32), langs)
    by_lang = [[s for s, k in samples if k == lang] for lang in langs]
    first, second = ([np.zeros_like(w) for w in net.arrays()] for _ in range(2))
    for step in range(1, rounds + 1):
        labels = rng.integers(len(langs), size=batch)
        chosen = [by_lang[k][rng.integers(len(by_lang[k]))] for k in labels]
        segments, lengths = padded(chosen, max(map(len, chosen)))
        _, slopes = loss_slopes(net, segments, lengths, labels)
        pace = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        for w, g, m, v in zip(net.arrays(), slopes, first, second, strict=True):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def padded(segments: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    joined = b"".join(s.ljust(width, b"\0") for s in segments)
    return (np.frombuffer(joined, np.uint8).reshape(len(segments), width),
            np.array([len(s) for s in segments]))


def cut(text: bytes, width: int = SEGMENT) -> list[bytes]:
    return [text[i:i + width] for i in range(0, len(text), width)]


def document_probabilities(net: Network, texts: list[str]) -> np.ndarray:
    """Mean over all byte positions of each text (rows of 0 for empty texts)."""
    pieces, owners = [], []
    for i, t in enumerate(texts):
        own = cut(t.encode("utf-8"))
        pieces += own
        owners += [i] * len(own)
    sums = np.zeros((len(texts), len(net.langs)))
    owner = np.array(owners, dtype=int)
    for a in range(0, len(pieces), LANES):
        segments, lengths = padded(pieces[a:a + LANES], SEGMENT)
        p = softmax(position_scores(net, segments, lengths))
        p *= (np.arange(SEGMENT)[:, None] < lengths[None, :])[..., None]
        np.add.at(sums, owner[a:a + LANES], p.sum(axis=0))
    return sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-12)


def training_sample(docs: DataFrame, fit_docs: int = FIT_DOCS,
                    fit_segments: int = FIT_SEGMENTS) -> list[tuple[bytes, str]]:
    """Segments of at most ``fit_docs`` documents of each language.

    The documents are the first by a hash of their ids; a long document gives
    segments spread over its whole length.
    """
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    few = (docs.select("doc_id", "lang").withColumn("place", F.row_number().over(first))
           .where(F.col("place") <= fit_docs).select("doc_id", F.col("lang").alias("label")))  # bounded, so broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, labels = [], []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(),
                                   strict=True):
                own = cut(text.encode("utf-8"))
                chosen = [own[i * len(own) // fit_segments] for i in range(fit_segments)] \
                    if len(own) > fit_segments else own
                out += chosen
                labels += [label] * len(chosen)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(labels, pa.string())],
                                             ["segment", "label"])
    rows = (docs.join(F.broadcast(few), "doc_id").where(F.col("label") == F.col("lang")).select("text", "label")
            .mapInArrow(run, "segment binary, label string"))
    return [(bytes(r.segment), r.label) for r in rows.collect()]  # bounded by the two parameters


def languages(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    ``held_out`` holds where crc32 of the id, as text, is divisible by 5; the
    network learns from the ``text`` and ``lang`` of the other documents only.
    A null text, or one without a letter, is ``und`` with score 0; so is every
    text when there is nothing to learn from.  A null id is not held out and not
    learned from.  Repeated rows give a row each; an empty table gives none;
    other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = columns_of(docs, "doc_id", "text", "lang").select(
        F.col("doc_id").cast("long"), "text", "lang",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False)).alias("held_out"))
    net = train(training_sample(base.where("NOT held_out AND doc_id IS NOT NULL AND text IS NOT NULL "
                                           "AND text != '' AND lang IS NOT NULL")))
    shared = send(spark, net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = received(shared, Network)
        for batch in batches:
            texts = [t if t and LETTER.search(t) else "" for t in batch.column("text").to_pylist()]
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if net is not None and texts:
                p = document_probabilities(net, texts)
                best = p.argmax(axis=1)
                langs = [net.langs[k] if t else UNKNOWN for k, t in zip(best, texts, strict=True)]
                scores = [float(min(p[i, k], 1.0)) if texts[i] else 0.0 for i, k in enumerate(best)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    return base.select("doc_id", "text", "held_out").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


ship(__name__)
