"""Removal of repeated byte strings by deep-shallow suffix sorting.

Every 400-byte string that occurs twice must be found, but not every suffix has
to be sorted.  A string's own content names an anchor inside it: the 32-byte
gram with the smallest hash of all grams in the string (the first of equals).
Equal strings have equal anchors at equal offsets, so strings need comparing only
if their anchors' grams agree, and only one suffix per anchor is sorted.

1.  One map finds the anchors of every text and, for each, the range of offsets
    ``d`` of the strings that it stands for.
2.  Anchors whose gram occurs once are done.  For the others the bytes around
    the anchor are sent to the task of their gram.
3.  There the suffixes that start at the anchors, and the reversed texts before
    the anchors, are sorted: by multikey quicksort over 8-byte words to a shallow
    depth, then by blind tries where long prefixes agree.  Neighbours' common lengths tell for every
    offset ``d`` which strings agree on ``d`` bytes before and ``length - d``
    bytes from the anchor on, that is, which strings occur twice.
4.  An anchor's repeated strings all cover the anchor, so they remove one run of
    bytes, from the largest to the smallest such offset.

Texts that occur twice as a whole are compared once and removed whole.  A gram
with very many anchors is first reduced to its distinct surroundings; if these
are still too many for a task, its strings are grouped one by one, by hash, over
the cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, ship, small_batches, text_or_empty, written

#: Bytes of a repeated string, and of the gram that anchors it.
LENGTH, GRAM = 400, 32
#: Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 48
#: Most anchors (then: distinct surroundings) of a gram that one task sorts.
TASK_ANCHORS = 20_000
#: Anchors that are solved together.
SOLVE_ROWS = 20_000
BASE = 0x9E3779B97F4A7C15
PLACE_BITS = 31


class Powers:
    """Powers of the hash base and of its inverse, as far as texts were long."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << n.bit_length()
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))


def spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(BASE)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(BASE)
    return h ^ (h >> np.uint64(32))


def anchors(text: bytes, powers: Powers, length: int = LENGTH,
            gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hashes, positions, smallest offsets, largest offsets) of a text's anchors.

    The anchor at position p stands for the strings that start at p - d for every
    d from its smallest to its largest offset.
    """
    n = len(text)
    if n < length:
        return (np.empty(0, np.int64),) * 4
    powers.reach(n)
    sums = np.concatenate([np.zeros(1, np.uint64),
                           np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1))
                                     * powers.down[:n])])
    grams = n - gram + 1
    h = spread((sums[gram:] - sums[:grams]) * powers.up[:grams])
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (h & ~low) | np.arange(grams, dtype=np.uint64)  # equal hashes: the first
    width = length - gram + 1
    blocks = -(-grams // width)
    padded = np.full(blocks * width, np.uint64(2 ** 64 - 1))
    padded[:grams] = keys
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    lowest = np.minimum(behind[:starts], ahead[width - 1:width - 1 + starts])
    places = (lowest & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    last = np.concatenate([first[1:] - 1, [starts - 1]])
    p = places[first]
    return h[p].view(np.int64), p, p - last, p - first


# ------------------------------------------------------- deep-shallow sorting
def agreed(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    while end - known > 1:
        middle = (known + end) // 2
        if a[known:middle] == b[known:middle]:
            known = middle
        else:
            end = middle
    return known


def blind_trie(strings: list[bytes], members: list[int], known: int) -> list[tuple[int, int]]:
    """The members in order, each with its common prefix with the one before.

    An inner node is ``[depth, {byte: child}]`` and skips all bytes that do not
    branch; a leaf is a list of equal strings.  A string first goes down blindly,
    by the branching bytes only, and is then compared with the one leaf it met.
    """
    root: list = [members[0]]
    for i in members[1:]:
        s = strings[i]
        node = root
        while isinstance(node[-1], dict):
            node = node[1].get(s[node[0]] if node[0] < len(s) else -1) or next(iter(node[1].values()))
        other = strings[node[0]]
        depth = agreed(s, other, known)
        if depth == len(s) == len(other):
            node.append(i)
            continue
        parent, node = None, root
        while isinstance(node[-1], dict) and node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        mine = s[depth] if depth < len(s) else -1
        if isinstance(node[-1], dict) and node[0] == depth:
            node[1][mine] = [i]
            continue
        inner = [depth, {other[depth] if depth < len(other) else -1: node, mine: [i]}]
        if parent is None:
            root = inner
        else:
            parent[1][s[parent[0]]] = inner
    out: list[tuple[int, int]] = []
    stack: list[tuple[list, int]] = [(root, known)]
    while stack:
        node, before = stack.pop()
        if isinstance(node[-1], dict):
            children = [node[1][c] for c in sorted(node[1])]
            stack += [(c, node[0]) for c in reversed(children[1:])] + [(children[0], before)]
        else:
            out.append((node[0], before))
            out += [(i, len(strings[i])) for i in node[1:]]
    return out


def multikey_quicksort(groups: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Order of the rows of ``words`` (big-endian words of a string) inside their groups.

    All segments of the array are partitioned at once: each draws a pivot word at its
    own depth, and its rows go to three parts, less, equal and greater.  The equal part
    goes on one word deeper, the others at the same depth.  Rows equal in all words
    keep their order.
    """
    order = np.argsort(groups, kind="stable")
    own = groups[order]
    start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    size = np.diff(np.concatenate([start, [len(order)]]))
    depth = np.zeros(len(start), np.int64)
    turn = 0
    while True:
        busy = (size > 1) & (depth < words.shape[1])
        start, size, depth = start[busy], size[busy], depth[busy]
        if not len(start):
            return order
        ahead = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(start)), size)
        at = np.arange(len(segment)) + (start - ahead)[segment]
        rows = order[at]
        word = words[rows, depth[segment]]
        turn += 1  # the median of three rows, other ones each turn
        drawn = np.stack([word[ahead + (k * size // 4 + turn * 7919) % size] for k in (1, 2, 3)])
        pivot = np.sort(drawn, axis=0)[1][segment]
        part = 3 * segment + (word >= pivot) + (word > pivot)
        order[at] = rows[np.argsort(part, kind="stable")]
        parts = np.bincount(part, minlength=3 * len(start)).reshape(-1, 3)
        start = (start[:, None] + np.cumsum(parts, axis=1) - parts).ravel()
        size = parts.ravel()
        depth = (depth[:, None] + np.array([0, 1, 0])).ravel()


def sorted_suffixes(groups: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order by group and string, common prefix of each with the one before; -1 at a group's start)."""
    n = len(strings)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lengths = np.fromiter(map(len, strings), np.int64, n)
    words = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8"
                          ).reshape(n, SHALLOW // 8).astype(np.uint64)
    order = multikey_quicksort(groups, words)
    inside = np.concatenate([[False], groups[order][1:] == groups[order][:-1]])  # not the first of its group
    differ = words[order][1:] ^ words[order][:-1]
    column = np.argmax(differ != 0, axis=1)  # the first word that differs
    differ = differ[np.arange(n - 1), column]
    same = sum(((differ >> np.uint64(64 - 8 * k)) == 0).astype(np.int64) for k in range(1, 8))
    lcp = np.concatenate([[-1], np.where(differ == 0, SHALLOW, 8 * column + same)])
    bounds = np.flatnonzero(np.concatenate([[True], ~(inside[1:] & (differ == 0)), [True]]))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a > 1:
            known = min(SHALLOW, int(lengths[order[a:b]].min()))
            found = blind_trie(strings, order[a:b].tolist(), known)
            order[a:b] = [i for i, _ in found]
            lcp[a + 1:b] = [v for _, v in found[1:]]
    shorter = np.minimum(lengths[order], np.concatenate([[0], lengths[order][:-1]]))
    lcp = np.where(inside, np.minimum(lcp, shorter), -1)
    return order, lcp


def repeated_offsets(groups: np.ndarray, before: list[bytes], after: list[bytes], low: np.ndarray,
                     high: np.ndarray, weights: np.ndarray, length: int = LENGTH
                     ) -> tuple[np.ndarray, np.ndarray]:
    """(smallest, largest) offset of the strings that occur twice; (-1, -1) without any.

    Member i has ``before[i]`` (``high[i]`` bytes, ending at the anchor) and
    ``after[i]`` (from the anchor on, ``length - low[i]`` bytes), and stands for
    ``weights[i]`` equal surroundings.
    """
    n = len(groups)
    left_order, left = sorted_suffixes(groups, [s[::-1] for s in before])
    right_order, right = sorted_suffixes(groups, after)
    smallest, largest = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(int(high.max(initial=-1)), -1, -1):
        here = np.flatnonzero((low <= d) & (d <= high))
        if not len(here):
            continue
        left_class[left_order] = np.cumsum(left < d)
        right_class[right_order] = np.cumsum(right < length - d)
        key = left_class[here] * (n + 1) + right_class[here]
        order = np.argsort(key, kind="stable")
        start = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        run = np.cumsum(start) - 1
        twice = here[order][np.bincount(run, weights=weights[here[order]])[run] >= 2]
        smallest[twice] = d
        largest[twice] = np.maximum(largest[twice], d)
    return smallest, largest


# ------------------------------------------------------------------ the job
def text_anchors(docs: DataFrame) -> DataFrame:
    """``doc_id, key, n_bytes`` and arrays ``gram, place, low, high`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            texts = [t.encode("utf-8") for t in batch.column("text").to_pylist()]
            found = [anchors(t, powers) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([len(t) for t in texts], pa.int64()),
                 *(pa.array([f[k] for f in found], pa.list_(pa.int64() if k == 0 else pa.int32()))
                   for k in range(4))],
                ["doc_id", "key", "n_bytes", "gram", "place", "low", "high"])
    return docs.mapInArrow(run, "doc_id long, key binary, n_bytes long, gram array<long>,"
                                " place array<int>, low array<int>, high array<int>")


def surroundings(texts: DataFrame) -> DataFrame:
    """A row per repeated anchor; bytes only with the first of equal ones in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows = []
            for text, key, found in zip(*(batch.column(c).to_pylist() for c in ("text", "key", "found")),
                                        strict=True):
                text = text.encode("utf-8")
                for f in found:
                    p, low, high = f["place"], f["low"], f["high"]
                    before, after = text[p - high:p], text[p:p - low + LENGTH]
                    around = hashlib.blake2b(b"%d %d " % (low, high) + before + after, digest_size=16).digest()
                    new = around not in seen
                    if new:
                        if len(seen) >= 1 << 20:
                            seen.clear()
                        seen.add(around)
                    rows.append((f["gram"], f["many"], around, key, p, low, high,
                                 before if new else None, after if new else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
            kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), *[pa.int32()] * 3, *[pa.binary()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], AROUND)
    return texts.mapInArrow(run, "gram long, many boolean, around binary, key binary, place int, low int,"
                                 " high int, before binary, after binary")


AROUND = ["gram", "many", "around", "key", "place", "low", "high", "before", "after"]


def solved(rows: DataFrame) -> DataFrame:
    """Offsets of the repeated strings of every distinct surrounding.

    ``rows``: ``gram, around, low, high, before, after, n`` (a null ``before``
    adds to the count only); all rows of a gram must be in one partition,
    sorted by gram and surrounding.  Returns ``gram, around, smallest, largest``.
    """

    def solve(grams: list, arounds: list, lows: list, highs: list, befores: list, afters: list,
              counts: list) -> pa.RecordBatch:
        low, high = np.array(lows, np.int64), np.array(highs, np.int64)
        _, groups = np.unique(np.array(grams, np.int64), return_inverse=True)
        small, large = repeated_offsets(groups, befores, afters, low, high, np.minimum(np.array(counts), 2))
        good = large >= 0
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(grams, np.int64)[good], pa.int64()),
             pa.array([a for a, g in zip(arounds, good, strict=True) if g], pa.binary()),
             pa.array(small[good], pa.int32()), pa.array(large[good], pa.int32())],
            ["gram", "around", "smallest", "largest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list] = [[] for _ in range(7)]
        current: list[list] = [[] for _ in range(7)]  # the distinct surroundings of the current gram

        def close() -> None:
            # a gram with one surrounding that occurs once has nothing to compare
            if len(current[0]) > 1 or current[0] and current[6][0] > 1:
                for a, b in zip(kept, current, strict=True):
                    a.extend(b)
            for b in current:
                b.clear()
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in
                             ("gram", "around", "low", "high", "before", "after", "n")), strict=True):
                if current[0] and current[0][-1] != row[0]:
                    close()
                    if len(kept[0]) >= SOLVE_ROWS:
                        yield solve(*kept)
                        kept = [[] for _ in range(7)]
                if current[0] and current[1][-1] == row[1]:
                    current[6][-1] += row[6]
                    if current[4][-1] is None:
                        current[4][-1], current[5][-1] = row[4], row[5]
                else:
                    for a, v in zip(current, row, strict=True):
                        a.append(v)
        close()
        if kept[0]:
            yield solve(*kept)
    return rows.select("gram", "around", "low", "high", "before", "after", "n").mapInArrow(
        run, "gram long, around binary, smallest int, largest int")


def grouped_strings(rows: DataFrame) -> DataFrame:
    """The same as ``solved`` for grams of any size: every string by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, around, low, high, before, after, n in zip(*(batch.column(c).to_pylist() for c in (
                    "gram", "around", "low", "high", "before", "after", "n")), strict=True):
                both = before + after
                d = list(range(low, high + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([gram] * len(d), pa.int64()), pa.array([around] * len(d), pa.binary()),
                     pa.array(d, pa.int32()), pa.array([n] * len(d), pa.int64()),
                     pa.array([hashlib.blake2b(both[high - v:high - v + LENGTH], digest_size=16).digest()
                               for v in d], pa.binary())], ["gram", "around", "d", "n", "string"])
    strings = rows.mapInArrow(run, "gram long, around binary, d int, n long, string binary")
    twice = strings.groupBy("string").agg(F.sum("n").alias("all")).where("all > 1").select("string")
    return (strings.join(twice, "string").groupBy("gram", "around")
            .agg(F.min("d").alias("smallest"), F.max("d").alias("largest")))


def by_gram(rows: DataFrame) -> DataFrame:
    return rows.repartition("gram").sortWithinPartitions("gram", "around")


def repeated_spans(around: DataFrame, task_anchors: int) -> DataFrame:
    """``key, start, stop`` of the bytes that the strings of an anchor remove."""
    usual = around.where("NOT many")
    few = solved(by_gram(usual.withColumn("n", F.lit(1).cast("long"))))
    # grams with very many anchors: distinct surroundings first
    many = around.where("many")
    distinct = (many.groupBy("gram", "around", "low", "high")
                .agg(F.count(F.lit(1)).alias("n"), F.max("before").alias("before"), F.max("after").alias("after")))
    sizes = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("size"))
    sized = written(distinct.join(sizes, "gram"))
    reduced = solved(by_gram(sized.where(F.col("size") <= task_anchors)))
    spread_out = grouped_strings(sized.where(F.col("size") > task_anchors))
    offsets = few.union(reduced).union(spread_out)
    return around.select("gram", "around", "key", "place").join(offsets, ["gram", "around"]).select(
        "key", (F.col("place") - F.col("largest")).alias("start"),
        (F.col("place") - F.col("smallest") + LENGTH).alias("stop"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, task_anchors: int = TASK_ANCHORS, texts: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A text's UTF-8 bytes that lie in a 400-byte string which also starts at
    another place, of the same or another document, are removed; ``n_spans``
    counts the maximal removed runs.  With ``texts``, the remaining bytes follow
    as ``kept`` (binary: a run may begin inside a character).  Null counts as
    empty; texts of less than 400 bytes lose nothing.  Repeated rows are
    documents of their own, so they remove each other.  An empty table gives no
    rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    base = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    keyed = base.withColumn("key", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    found = written(text_anchors(base))
    # the tables with one row per key are written, so that the joins to them are plain shuffles,
    # whose hot keys Spark splits
    distinct = written(found.where(F.size("gram") > 0).groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")))
    # one document stands for all equal ones
    alone = (found.join(distinct, "key").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
             .select("key", F.explode(F.arrays_zip("gram", "place", "low", "high")).alias("a"))
             .select("key", "a.*"))
    ties = has_repeated_ids(found)
    alone = alone.distinct() if ties else alone
    repeated = written(alone.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    wanted = (alone.join(repeated, "gram")
              .groupBy("key").agg(F.collect_list(F.struct(
                  "gram", (F.col("times") > task_anchors).alias("many"), "place", "low", "high")).alias("found")))
    first_texts = keyed.where(F.octet_length("text") >= LENGTH).join(
        wanted.join(distinct, "key"), "key").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    first_texts = first_texts.select("key", "text", "found")
    around = written(surroundings(first_texts.dropDuplicates(["key"]) if ties else first_texts))
    spans = repeated_spans(around, task_anchors).groupBy("key").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans"))
    removal = written(distinct.select("key", (F.col("copies") > 1).alias("copied")).join(
        spans, "key", "left").where("copied OR spans IS NOT NULL"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs, shas, left = [], [], [], [], []
            for text, copied, own in zip(*(batch.column(c).to_pylist() for c in ("text", "copied", "spans")),
                                         strict=True):
                text = text.encode("utf-8")
                gone = [(0, len(text))] if copied else merged([(s["start"], s["stop"]) for s in own or ()])
                kept, at = [], 0
                for a, b in gone:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                rest = b"".join(kept)
                sizes.append(len(text))
                removed.append(len(text) - len(rest))
                runs.append(len(gone))
                shas.append(hashlib.sha256(rest).hexdigest())
                left.append(rest if texts else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (sizes, removed, runs)),
                 pa.array(shas, pa.string()), pa.array(left, pa.binary())], [*NAMES, "kept"])
    out = keyed.join(removal, "key", "left").select("doc_id", "text", "copied", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if texts else out.drop("kept")


def has_repeated_ids(found: DataFrame) -> bool:
    """Are there several rows of one id (or without an id) and text?"""
    return not found.groupBy("doc_id", "key").count().where("count > 1").isEmpty()


NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

ship(__name__)
