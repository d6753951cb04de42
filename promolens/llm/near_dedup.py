"""Near-duplicate documents: one-permutation MinHash with optimal densification.

1.  One map over the texts: the distinct word shingles of a document, hashed to
    64 bits, fall into ``BINS`` bins by their value; each bin's smallest hash is
    its sketch, an empty bin takes that of a full bin chosen by its own sequence
    of probes.  Bands of ``ROWS`` bins give bucket keys.
2.  Documents with the same set become one representative.
3.  In a bucket every member is joined to one centre (star edges), so a bucket
    of m members gives m - 1 candidate pairs.  The centre is the member with the
    most bucket mates overall, the least changed text of its kind, so that the
    buckets of one group give the same pairs.  Candidates are confirmed on the
    full shingle sets.  Links become components.
4.  A star can miss a link between two members that are both unlike the centre.
    Buckets whose members still lie in several components are therefore compared
    block by block, on the full sets and inside the task, which gives only the
    links that join components.

Two sets with similarity s share a bucket with probability
``1 - (1 - s**ROWS)**(BINS/ROWS)``: 0.9999999 at 0.8, so only step 1 is
probabilistic; no later step loses a link between bucket mates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, let_go, ship, small_batches, text_or_empty, written
from .components import components

#: Bins of the sketch and bins of a band.
BINS, ROWS = 200, 5
BANDS = BINS // ROWS
#: Distinct words whose hashes a worker remembers before it starts anew.
MEMO_WORDS = 400_000
#: Members of a bucket that are compared with one another in one task.
BLOCK = 2048
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of the words seen so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (multiply and shift, three times)."""
    with np.errstate(over="ignore"):
        for shift in (32, 29, 32):
            h = (h ^ (h >> np.uint64(shift))) * MIX
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``size`` words.

    A-Z become lower case; words are parted by the six ASCII blanks; fewer words
    than ``size`` are one shingle; no words, none.
    """
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - size + 1, 1)
    out = np.full(n, np.uint64(min(size, len(words))))
    for k in range(min(size, len(words))):
        out = mixed(out + h[k:k + n])
    return np.unique(out)


PROBES = np.array([[int(mixed(np.array([b * 1009 + a + 1], np.uint64))[0]) % BINS for b in range(BINS)]
                   for a in range(64)])


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of every bin; empty bins take that of the bin they probe first."""
    bins = (shingles >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)  # shingles are sorted, so are these
    first = np.searchsorted(bins, np.arange(BINS, dtype=np.uint64))
    full = np.zeros(BINS, bool)
    full[bins.astype(np.int64)] = True
    out = shingles[np.minimum(first, len(shingles) - 1)]
    empty = np.flatnonzero(~full)
    for probe in PROBES:
        if not len(empty):
            return out
        source = probe[empty]
        hit = full[source]
        out[empty[hit]] = out[source[hit]]
        empty = empty[~hit]
    full_bins = np.flatnonzero(full)  # very small sets: the nearest full bin after it
    out[empty] = out[full_bins[np.searchsorted(full_bins, empty) % len(full_bins)]]
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One signed 64-bit key for each band."""
    rows = minima.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        key = mixed(key + rows[:, k])
    return key.view(np.int64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands`` of every document with words or without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hashes = WordHashes()
        for batch in batches:
            counts, keys, bands = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, size, hashes)
                counts.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(sketch(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_key", "bands"])
    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``id, shingles`` (sorted hashes as bytes) of the documents in ``ids``.

    A merge join at every size: the ids grow with the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hashes = WordHashes()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([shingle_set(t, size, hashes).tobytes() for t in batch.column("text").to_pylist()],
                          pa.binary())], ["id", "shingles"])
    return docs.join(ids.withColumnRenamed("id", "doc_id").hint("merge"), "doc_id", "left_semi").mapInArrow(
        run, "id long, shingles binary")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Is the intersection of two sets large enough against their union?"""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).to_pylist() for c in ("sa", "sb"))
            good = []
            for x, y in zip(left, right, strict=True):
                good.append(similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
    sa, sb = (sets.select(F.col("id").alias(k), F.col("shingles").alias("s" + k)) for k in "ab")
    return pairs.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def similar_sizes(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose set sizes alone leave room for enough similarity."""
    na, nb = (reps.select(F.col("id").alias(k), F.col("n").alias("n" + k)) for k in "ab")
    return (pairs.join(na, "a").join(nb, "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b"))


def shared_buckets(reps: DataFrame) -> DataFrame:
    """``key, id, size`` of the members of buckets that have several."""
    members = reps.select("id", F.explode("bands").alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return members.join(sizes, "key").select("key", "id", "size")


def star_pairs(buckets: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of each member with the centres of its buckets."""
    mates = buckets.groupBy("id").agg(F.sum("size").alias("mates"))
    centres = (buckets.join(mates, "id").groupBy("key")
               .agg(F.max(F.struct("mates", (-F.col("id")).alias("minus"))).alias("top"))
               .select("key", (-F.col("top.minus")).alias("centre")))
    pairs = (buckets.join(centres, "key").where("id != centre")
             .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct())
    return similar_sizes(pairs, reps, percent)


def remaining_links(buckets: DataFrame, reps: DataFrame, sets: DataFrame, labels: DataFrame,
                    percent: int) -> DataFrame:
    """Links (a, b) between bucket mates in different components.

    A bucket is dealt to blocks of ``BLOCK`` members at random and every pair of
    blocks is one task's work.  A pair is looked at in its first common band only,
    and only if its sketches share two bands (probability 0.9999974 at 0.8); pairs
    that the task's own links have joined by then are left out.
    """
    rows = buckets.join(labels, "id").select("key", "id", "component")
    mixed_up = (rows.groupBy("key")
                .agg(F.min("component").alias("low"), F.max("component").alias("high"),
                     F.count(F.lit(1)).alias("size"))
                .where("low != high")
                .select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    dealt = (rows.join(mixed_up, "key")
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "id", "component")
             .join(reps.select("id", "bands").join(sets, "id"), "id"))

    def compare(key: int, i: int, j: int, members: list[dict]) -> list[tuple[int, int]]:
        members.sort(key=lambda m: m["id"])
        ids, comps = [m["id"] for m in members], [m["component"] for m in members]
        bands = np.array([m["bands"] for m in members])
        full = [np.frombuffer(m["shingles"], np.uint64) for m in members]
        sizes = np.array([len(f) for f in full])
        block = np.array([m["block"] for m in members])
        band = int(np.flatnonzero(bands[0] == key)[0])
        parent = {c: c for c in comps}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c
        found = []
        for x in range(len(ids)):
            rest = slice(x + 1, len(ids))
            same = bands[rest] == bands[x]
            good = ((same.sum(axis=1) >= 2) & (same.argmax(axis=1) == band)
                    & (100 * np.minimum(sizes[rest], sizes[x]) >= percent * np.maximum(sizes[rest], sizes[x])))
            if i != j:
                good &= block[rest] != block[x]
            for y in np.flatnonzero(good) + x + 1:
                cx, cy = root(comps[x]), root(comps[y])
                if cx != cy and similar(full[x], full[y], percent):
                    parent[cx] = cy
                    found.append((ids[x], ids[y]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members, found = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                mine = (row["key"], row["i"], row["j"])
                if mine != group:
                    if members:
                        found += compare(*group, members)
                    group, members = mine, []
                members.append(row)
        if members:
            found += compare(*group, members)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])
    return (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(run, "a long, b long").distinct())


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked when the distinct ``size``-word shingles of both
    are at least ``percent`` percent of those of either; ``component_id`` is the
    smallest id reached over links, itself included, and ``kept`` marks it.
    Null, empty and blank texts have no shingle and are linked with nothing.
    Rows with a null id are not linked and stay as they are (``component_id``
    null, kept).  Repeated rows of one id and text are one document; an id names
    one text, and of several texts under one id any one is compared.  An empty table gives no rows;
    other columns are ignored.
    """
    small_batches(docs.sparkSession)
    base = columns_of(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    seen = written(sketches(base, size))
    known = seen.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    same = known.groupBy("set_key").agg(F.min("doc_id").alias("id"))
    # representatives: the smallest id of every distinct set
    owners = known.join(same, "set_key").select("doc_id", "id", "n_shingles", "bands")
    reps = (owners.where(F.col("doc_id") == F.col("id"))
            .select("id", F.col("n_shingles").alias("n"), "bands").distinct())
    reps = written(reps)
    buckets = written(shared_buckets(reps))
    sets = written(full_sets(base, buckets.select("id").distinct(), size).dropDuplicates(["id"]))
    copies = owners.where(F.col("doc_id") != F.col("id")).select(
        F.col("id").alias("a"), F.col("doc_id").alias("b")).distinct()

    links = written(confirmed(written(star_pairs(buckets, reps, percent)), sets, percent))
    labels = components(links)
    known_labels = reps.select("id").join(labels, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component"))
    more = written(remaining_links(buckets, reps, sets, known_labels, percent))
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links)
    labels = components(links.union(copies)) if has_several_texts(known) else joined_copies(labels, copies)
    return seen.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def has_several_texts(known: DataFrame) -> bool:
    """Does an id have rows with different sets?"""
    return not (known.groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y"))
                .where("x != y").isEmpty())


def joined_copies(labels: DataFrame, copies: DataFrame) -> DataFrame:
    """Labels of representatives, and the same for the documents with equal sets."""
    own = copies.join(labels, copies["a"] == labels["id"], "left").select(
        F.col("b").alias("id"), F.coalesce("component", "a").alias("component"))
    return labels.union(own)


ship(__name__)
