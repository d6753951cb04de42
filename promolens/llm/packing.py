"""Best-fit packing of tokenised documents into sequences of bounded length.

Lengths are whole numbers up to the capacity, so documents and gaps, sorted by
size, fall into runs of equals.  Best fit goes in bulk-synchronous rounds over the
tables of these runs, each round a Spark job:

1.  Documents and gaps are sorted by size into ranges.  A sweep down every range
    matches documents with their successors (the smallest gaps that hold them); what
    finds no mate in its range goes to a sweep over half as many, wider ranges.
2.  Of documents that want one gap the longer has it (rank); the others go on.
3.  The gaps shrink by what they took and are written, with what is left, for the next
    round.  Where no gap holds any document, new sequences are opened, nine tenths of
    the least number that the rest needs, so that the last ones open a few at a time.

A round places a length in at most as many gaps as there are runs, so the runs are
bounded by the capacity and the number of rounds, whatever the corpus.  The outcome is
a table "documents of this length from this rank on go to these sequences".
Tokenising, ranking and placing the single documents is distributed.
"""

from __future__ import annotations

import array
import math
import os
import string
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, kept_by_worker, ship, small_batches, written

#: Tokens of a sequence.
CAPACITY = 2048
#: The id after every document.
END_ID = 0
#: Kinds of runs: gaps, documents, placed documents, gaps for the next round.
GAP, DOCUMENT, PLACED, UPDATED = range(4)
RUN = ["kind", "size", "first", "n", "sequence", "offset"]
RUN_SCHEMA = ", ".join(f"{c} long" for c in RUN)
#: Runs that one task sweeps at first.
RANGE_RUNS = 16_384
#: Share of the least number of sequences that the rest needs, to be opened at once.
OPENED = 0.9
#: Distinct words whose ids a worker remembers before it starts anew.
MEMO_WORDS = 800_000
#: Signs at the end of a word that never join a token with letters (an apostrophe may).
ENDS = string.punctuation.replace("'", "")
#: Words of letters that the tokenizer reads at once.
JOINED = 500


class WordIds(dict):
    """The ids (little-endian, as bytes) of blank-separated words seen so far.

    Only for tokenizers that drop white space and never let a token cross it:
    the ids of a text are then those of its words, in order.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def stays_letters(self, stem: str) -> bool:
        """Whether the tokenizer reads letters only: it may turn a letter into a
        letter and a mark, and a mark joins the signs that follow."""
        return self.tokenizer.normalizer.normalize_str(stem).isalpha()

    def learn(self, words: set[str]) -> None:
        """Adds the missing words."""
        if len(self) >= MEMO_WORDS:
            self.clear()
        tails = []  # words that end with signs: letters and signs never share a token
        # not by differences with self: of a dict's heirs, sets look at every key
        fresh = set(filterfalse(self.__contains__, words))
        for w in list(fresh):
            if w[-1:] in ENDS:
                stem = w.rstrip(ENDS)
                if stem.isalpha() and (stem.isascii() or self.stays_letters(stem)):
                    tails.append((w, stem, w[len(stem):]))
                    fresh.discard(w)
        fresh.update(x for _, stem, end in tails for x in (stem, end) if x not in self)
        plain = [w for w in fresh if w.isalpha()]
        rest = list(fresh.difference(plain))
        for a in range(0, len(plain), JOINED):  # words of letters: one call for many
            some = plain[a:a + JOINED]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            cuts = [0, *(np.flatnonzero(np.diff(np.array(found.word_ids))) + 1).tolist(), len(found.ids)]
            if len(cuts) != len(some) + 1:  # a word that is more than one word to the tokenizer
                rest += some
                continue
            ids = array.array("I", found.ids).tobytes()
            for w, x, y in zip(some, cuts[:-1], cuts[1:], strict=True):
                self[w] = ids[4 * x:4 * y]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self[w] = array.array("I", e.ids).tobytes()
        for w, stem, end in tails:
            self[w] = self[stem] + self[end]


def text_words(text: str | None) -> list[str]:
    """Words of a text, parted by blanks and line ends.

    In lower case where that is sign by sign the same as what the tokenizer does
    itself; not with what might be one of its special tokens.
    """
    text = (text or "").replace("\n", " ")
    if "<|" not in text and (text.isascii() or is_latin(text)):
        text = text.lower()
    return text.split(" ")


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """The pieces of all documents, with their place among equals of their task."""
    end = array.array("I", [END_ID]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_by_worker(f"ids {tokenizer_path}", lambda: WordIds(tokenizer_path))
        part, ranks = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            texts = [text_words(t) for t in batch.column("text").to_pylist()]
            known.learn({w for words in texts for w in words})
            owner, rows = [], []
            for i, words in enumerate(texts):
                ids = b"".join(map(known.__getitem__, words)) + end
                for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[a:a + 4 * capacity]
                    n = len(own) // 4
                    owner.append(i)
                    rows.append((k, a // 4, n, zlib.crc32(own), part, ranks[n]))
                    ranks[n] += 1
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner, pa.int64())),
                 *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"])
    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long,"
                                " part long, place long")


def sweep(rows: Iterable[tuple[int, ...]], capacity: int) -> list[tuple[int, ...]]:
    """Match documents with their successors, the smallest gaps that hold them.

    ``rows`` are runs (kind, size, first, n, sequence, offset) of a range of sizes,
    from the largest size down, gaps before documents.  Where several documents
    want one gap, the first in rank (the longest) has it.  The gaps passed so far
    and not taken wait on a stack, the smallest on top, so a match found inside a
    range is also that of all ranges together; what finds no mate is returned as
    it came, for a sweep over wider ranges.  A gap takes as many equal documents
    as it holds; what is left of it is an ``UPDATED`` gap of the next round.
    """
    waiting: list[tuple[int, int, int]] = []
    out: list[tuple[int, ...]] = []
    for row in rows:
        kind, size, first, n = row[:4]
        if kind == GAP:
            waiting.append((size, first, n))
        elif kind != DOCUMENT:
            out.append(row)
        else:
            while n and waiting:
                gap, sequence, there = waiting.pop()
                used = min(there, -(-n // (gap // size)))
                if there > used:
                    waiting.append((gap, sequence + used, there - used))
                while used and gap >= size:  # one more document into each of these gaps
                    now = min(used, n)
                    if now:
                        out.append((PLACED, size, first, now, sequence, capacity - gap))
                        first, n = first + now, n - now
                    if used > now:
                        out.append((UPDATED, gap, sequence + now, used - now, 0, 0))
                    used, gap = now, gap - size
                if used and gap:
                    out.append((UPDATED, gap, sequence, used, 0, 0))
            if n:
                out.append((DOCUMENT, size, first, n, 0, 0))
    return out + [(GAP, *run, 0, 0) for run in waiting]


def swept(runs: DataFrame, capacity: int, ranges: int) -> DataFrame:
    """One round's matches: sweeps over ranges of sizes, half as many each time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        found = sweep(rows, capacity)
        columns = list(zip(*found, strict=True)) if found else [[]] * len(RUN)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], RUN)
    order = [F.desc("size"), F.asc("kind"), F.asc("first")]
    while True:
        dealt = runs.coalesce(1) if ranges == 1 else runs.repartitionByRange(ranges, *order[:2])
        runs = dealt.sortWithinPartitions(*order).mapInArrow(run, RUN_SCHEMA)
        if ranges == 1:
            return runs
        ranges = -(-ranges // 2)


def openings(tokens: int, halves: int, capacity: int) -> int:
    """New sequences when nothing fits any more: most of what the rest needs at least."""
    return max(math.ceil(tokens * OPENED / capacity), halves, 1)


def best_fit(lengths: DataFrame, capacity: int, range_runs: int = RANGE_RUNS) -> DataFrame:
    """Bulk-synchronous best fit of the runs ``length, n``: rows ``length, rank, n,
    sequence, offset``.

    Documents of one length are ranked from 0; the ``n`` ones from ``rank`` on go, one
    each, to consecutive sequences from ``sequence`` on, at ``offset``.  In a round, all
    documents and gaps, sorted by size, are matched by sweeps; conflicts go by rank; the
    gaps are updated and the next round begins.  When the largest gap is too small for
    the shortest document, new sequences are opened.  A round reads what the round
    before wrote, so a lost executor costs a part of one round.
    """
    spark = lengths.sparkSession
    state = written(lengths.select(F.lit(DOCUMENT).alias("kind"), F.col("length").alias("size"),
                                   F.lit(0).alias("first"), "n", F.lit(0).alias("sequence"),
                                   F.lit(0).alias("offset")).select(*[F.col(c).cast("long") for c in RUN]))
    rounds, opened = [state], 0
    is_document = F.col("kind") == DOCUMENT
    while True:
        now = state.where(F.col("kind") != PLACED).coalesce(1).agg(
            F.count(F.lit(1)).alias("runs"), F.min(F.when(is_document, F.col("size"))).alias("shortest"),
            F.max(F.when(~is_document, F.col("size"))).alias("widest"),
            F.sum(F.when(is_document, F.col("size") * F.col("n"))).alias("tokens"),
            F.sum(F.when(is_document & (2 * F.col("size") > capacity), F.col("n"))).alias("halves")).first()
        if now.shortest is None:
            break
        runs = state.where(F.col("kind") != PLACED).withColumn(
            "kind", F.when(is_document, F.col("kind")).otherwise(F.lit(GAP).cast("long")))
        if (now.widest or 0) < now.shortest:
            more = openings(now.tokens, now.halves or 0, capacity)
            runs = runs.union(spark.createDataFrame([(GAP, capacity, opened, more, 0, 0)], RUN_SCHEMA))
            opened += more
        state = written(swept(runs, capacity, -(-now.runs // range_runs)))
        rounds.append(state)
    return (spark.read.schema(RUN_SCHEMA).parquet(*[r._written_at for r in rounds])
            .where(F.col("kind") == PLACED)
            .select(F.col("size").alias("length"), F.col("first").alias("rank"), "n", "sequence", "offset"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    A document is the ids of its text, without special tokens, then id 0; only
    documents of more than ``capacity`` ids are cut, into pieces of that many
    (the last may be shorter).  The pieces of a sequence follow each other from
    offset 0 without gaps.  A null text counts as empty: one piece of length 1.
    Repeated rows and null ids are packed as documents of their own; ties in
    length are ordered by their place in the input.  An empty table gives no
    rows; other columns are ignored.  The executors read the tokenizer file.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    pieces = written(pieces_of(base, tokenizer_path, capacity))
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    fitted = best_fit(by_part.groupBy("length").agg(F.sum("n").alias("n")), capacity)
    placements = fitted.orderBy("length", "rank").select("length", "rank", "sequence", "offset").toPandas()
    plan = spark.sparkContext.broadcast(placements.to_numpy(np.int64).reshape(-1, 4))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("earlier") + F.col("place")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        keys = table[:, 0] << 44 | table[:, 1] if len(table) else None
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            if not len(rank):
                continue
            row = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in NAMES[:5]),
                 pa.array(table[row, 2] + rank - table[row, 1], pa.int64()),
                 pa.array(table[row, 3], pa.int64())], NAMES)
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long,"
                                    " sequence_id long, offset long")


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

ship(__name__)
