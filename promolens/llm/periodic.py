"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period ``q`` that repeats it at least
``exponent`` times and cannot be made longer.  For every power of two ``B`` the
periods from ``B`` to ``2B - 1`` are found together:

1.  Blocks of ``2B`` words start at every multiple of ``B``.  A run with such a period
    holds one of them, and the same block again ``q`` words later.
2.  Doubling sorts the places of repeated blocks into a suffix array; the places of
    a block are a range of it, at every level.
3.  A wavelet matrix over the array answers, for all blocks at once, which places
    of a block lie ``B`` to ``2B - 1`` words further on: how many, the first and
    the second (range successors).
4.  One place gives one candidate period.  Several are a progression whose
    difference is the period of the block itself; the ends of the two stretches
    with that period tell the only longer period that is possible.
5.  A candidate is extended in both directions, word by word, and measured.

All texts of a batch are worked through together; a text's words have numbers of
their own, so no block repeats in another text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, ship, small_batches

#: A run has at least as many words, and repeats its period as often.
LEAST, EXPONENT = 6, 4


class WaveletMatrix:
    """Counts and quantiles of the values in ranges of an array, for many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each range are smaller than ``x``."""
        found = np.where(x >> self.bits > 0, high - low, 0)  # larger than every value
        for i, zeros in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - i)) & 1 == 1
            a, b = zeros[low], zeros[high]
            found += np.where(one & (x >> self.bits == 0), b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return found

    def quantile(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank ``k`` (from 0) of each range."""
        out = np.zeros(len(k), np.int64)
        for i, zeros in enumerate(self.zeros):
            a, b = zeros[low], zeros[high]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            out |= one.astype(np.int64) << (self.bits - 1 - i)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return out


def groups_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of equal values in a sorted array."""
    edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])


def block_ranges(words: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple]]:
    """(suffix array of the places of repeated blocks, and per level
    ``(B, places, range starts, range ends)`` of the blocks of 2B words)."""
    n = len(words)
    keys = words[:-1] * (words.max() + 1) + words[1:]
    order = np.argsort(keys, kind="stable")
    starts, ends = groups_of(keys[order])
    big = ends - starts > 1
    size = (ends - starts)[big]
    array = order[np.repeat(big, ends - starts)]
    high = np.cumsum(size)
    low = high - size
    live, levels, width = np.arange(len(array)), [], 2
    while len(live):
        group = np.repeat(np.arange(len(low)), high - low)  # of each live entry
        half, at = width // 2, array[live]
        first = at % half == 0
        levels.append((half, at[first], low[group][first], high[group][first]))
        if width * 2 > longest // 2:
            break
        classes = np.full(n + width, -1, np.int64)
        classes[at] = group
        keys = group * (len(low) + 1) + classes[at + width] + 1
        order = np.argsort(keys, kind="stable")
        array[live] = at[order]
        keys = keys[order]
        starts, ends = groups_of(keys)
        big = (ends - starts > 1) & (keys[starts] % (len(low) + 1) > 0)
        inside = np.repeat(big, ends - starts)
        low, high = live[starts[big]], live[ends[big] - 1] + 1
        live, width = live[inside], width * 2
    return array, levels


class Stretches:
    """Longest stretches with a given period around a place; the last one is remembered."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.period, self.start, self.end = 0, 0, 0

    def around(self, at: int, period: int) -> tuple[int, int]:
        """(start, end) of the stretch; ``words[at]`` must equal ``words[at + period]``."""
        if period == self.period and self.start <= at < self.end - period:
            return self.start, self.end
        w, step, stop = self.words, 16, at
        while stop + period < len(w):  # to the right, in growing steps
            m = min(step, len(w) - period - stop)
            differ = np.flatnonzero(w[stop:stop + m] != w[stop + period:stop + period + m])
            if len(differ):
                stop += int(differ[0])
                break
            stop, step = stop + m, step * 2
        step, start = 16, at
        while start > 0:
            m = min(step, start)
            differ = np.flatnonzero(w[start - m:start] != w[start - m + period:start + period])
            if len(differ):
                start += int(differ[-1]) + 1 - m
                break
            start, step = start - m, step * 2
        self.period, self.start, self.end = period, start, stop + period
        return self.start, self.end


def candidates(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows ``(period, place)``: every run has one with its period."""
    array, levels = block_ranges(words, longest)
    if not len(array):
        return np.empty((0, 2), np.int64)
    places = np.sort(array)
    matrix = WaveletMatrix(np.searchsorted(places, array))
    found, several = [], []
    for half, at, low, high in levels:
        before = matrix.below(low, high, np.searchsorted(places, at + half))
        times = matrix.below(low, high, np.searchsorted(places, at + 2 * half)) - before
        some = times > 0
        at, low, high, before, times = at[some], low[some], high[some], before[some], times[some]
        first = places[matrix.quantile(low, high, before)]
        one = times == 1
        found.append(np.stack([first[one] - at[one], at[one]], axis=1))
        more = ~one
        second = places[matrix.quantile(low[more], high[more], before[more] + 1)]
        several.append(np.stack([second - first[more], at[more], first[more]], axis=1))
    stretches, later = Stretches(words), []
    many = np.concatenate(several)
    for period, at, first in many[np.lexsort((many[:, 1], many[:, 0]))].tolist():
        start, end = stretches.around(at, period)
        if first < end - period:
            continue  # one stretch: every distance is a multiple of its period
        other_start, other_end = stretches.around(first, period)
        later += [(other_end - end, at), (other_start - start, at)]
    return np.concatenate([*found, np.array(later, np.int64).reshape(-1, 2)])


def runs_of(words: np.ndarray, longest: int, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs, by start and period.

    ``words``: numbers of the words of one or several texts, one after the other;
    texts have no number in common.  ``longest``: words of the longest text.
    ``exponent`` is at least 4: that is what the blocks' widths rest on.
    """
    if exponent < 4:
        raise ValueError("runs are found from four periods on")
    if longest < max(least, exponent):
        return np.empty((0, 3), np.int64)
    stretches, out = Stretches(words), {}
    pairs = candidates(words, longest)
    pairs = pairs[(pairs[:, 0] > 0) & (pairs[:, 0] * exponent <= longest)]
    known = 0, 0  # period and end of the places of the last stretch
    for period, at in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
        if period == known[0] and at < known[1]:
            continue
        if at + period >= len(words) or words[at] != words[at + period]:
            continue
        start, end = stretches.around(at, period)
        known = period, end - period
        if end - start >= max(least, exponent * period):
            out.setdefault((start, end), period)  # smaller periods come first
    rows = sorted(((start, end - start, period) for (start, end), period in out.items()),
                  key=lambda r: (r[0], r[2]))
    return np.array(rows, np.int64).reshape(-1, 3)


def numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Numbers of the words of all texts; equal words of one text have equal numbers."""
    out, base = [], 0
    for words in texts:
        known = {w: i for i, w in enumerate(dict.fromkeys(words))}
        out.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)) + base)
        base += len(known)
    return np.concatenate([*out, np.empty(0, np.int64)])


def runs_of_texts(texts: list[list[bytes]], least: int, exponent: int) -> list[np.ndarray]:
    """The runs of every text, with starts counted from its first word."""
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)])
    if not first[-1]:
        return [np.empty((0, 3), np.int64)] * len(texts)
    found = runs_of(numbered(texts), int(lengths.max()), least, exponent)
    cuts = np.searchsorted(found[:, 0], first)
    shift = np.array([1, 0, 0])
    return [found[a:b] - shift * f for a, b, f in zip(cuts[:-1], cuts[1:], first, strict=False)]


RUNS = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT,
                  arrange: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, collapsed``.

    Words are what ASCII white space parts.  ``runs`` has ``start`` (word number from
    0), ``length`` and smallest ``period`` of every stretch of at least ``least`` words
    that repeats its period ``exponent`` times (4 or more) and that neither neighbour
    extends, by start, then period.  ``collapsed`` are the words, joined by a blank,
    without those that a run holds after its first period.  ``arrange`` may change the
    words of a text first.

    Null and empty texts have no words and no runs.  A text is worked through whole, however
    long; texts of one batch are worked through together, and each alone gives the
    same.  Runs may overlap; a stretch that has several periods counts with the smallest.
    Repeated rows and null ids give a row each; an empty table gives none;
    other columns are ignored.
    """
    small_batches(docs.sparkSession)
    base = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = [(t or "").encode("utf-8").split() for t in batch.column("text").to_pylist()]
            if arrange:
                texts = [arrange(i, t) for i, t in zip(ids, texts, strict=True)]
            found = runs_of_texts(texts, least, exponent)
            collapsed = []
            for words, own in zip(texts, found, strict=True):
                if len(own):
                    keep = np.ones(len(words), bool)
                    for start, length, period in own.tolist():
                        keep[start + period:start + length] = False
                    words = [words[i] for i in np.flatnonzero(keep)]
                collapsed.append(b" ".join(words).decode("utf-8"))
            flat = np.concatenate([*found, np.empty((0, 3), np.int64)])
            cuts = np.concatenate([[0], np.cumsum([len(f) for f in found])])
            rows = pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(flat[:, k], pa.int64()) for k in range(3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), rows.cast(kind),
                 pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
    return base.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


ship(__name__)
