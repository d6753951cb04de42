"""Phrase collocation mining by direct-address tiling.

Words have numbers by falling frequency, so that the pairs that occur most lie in few
square tiles of the table of all pairs.  A tile with many occurrences is counted in a
dense array (``np.bincount`` over its cells); what is left is counted as sorted
coordinates.  Pairs that are frequent are numbered by frequency again, and the next
length is found the same way: a phrase of ``k`` words is a pair of overlapping phrases of
``k - 1`` words.

1.  One map cuts the texts of every language into blocks of word numbers of their
    own, each with its dictionary; words are counted over the dictionaries.
2.  Every block counts its own pairs.  The counts go to buckets by tile; a bucket adds
    up what all blocks sent and keeps the frequent pairs.
3.  The numbers of the frequent words and pairs go back to the blocks: as a broadcast table
    where their count is below a bound, else the way they came: each bucket tells each
    block about the pairs that it sent, so that a task holds a block or the pairs of a bucket.
4.  Scores come from joins of the tables of frequent phrases: the parts of a frequent
    phrase are frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.operators.ordering import rank_within_group

from .common import columns_of, removed, ship, small_batches, text_or_empty, written

#: A phrase has from 2 to as many words, and occurs at least as often.
MOST_WORDS, LEAST = 5, 100
#: Words (with the ends of pieces) of a block, and about as many whose pairs are counted at once.
BLOCK_WORDS, COUNT_WORDS = 1 << 17, 1 << 20
#: Side of a tile (a power of two), and the occurrences from which it is counted densely.
SIDE_BITS, DENSE = 10, 1 << 16
#: Tiles with coordinates below this may be dense.
DENSE_TILES = 16
#: Pairs that a bucket gathers before it adds them up.
MERGE_PAIRS = 1 << 20
#: Most frequent words, and most frequent pairs, that are broadcast: some 100 and 50 MB.
BROADCAST_WORDS, BROADCAST_PAIRS = 500_000, 4_000_000
#: Language of texts without one.
UNKNOWN = "und"

UPPER, LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
#: A-Z to lower case, and every end of a piece to a comma (so no word holds one).
TABLE = bytes.maketrans(UPPER + PIECE_ENDS, LOWER + b"," * len(PIECE_ENDS))


def words_of(text: str) -> list[bytes]:
    """The words of a text, with a comma between pieces."""
    return text.encode("utf-8").translate(TABLE).replace(b",", b" , ").split()


class Numbers(dict):
    """Numbers of words in the order in which they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b",": 0})

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


# ------------------------------------------------------------------ counting
def dense_tile(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(x, y, counts) of the pairs of one tile, by its cells."""
    side = 1 << SIDE_BITS
    cells = ((x & (side - 1)) << SIDE_BITS) | (y & (side - 1))
    counts = np.bincount(cells, weights=weights, minlength=side * side)
    hit = np.flatnonzero(counts)
    return ((x[0] >> SIDE_BITS << SIDE_BITS) + (hit >> SIDE_BITS),
            (y[0] >> SIDE_BITS << SIDE_BITS) + (hit & (side - 1)), counts[hit].astype(np.int64))


def sorted_pairs(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(x, y, counts) of pairs as sorted coordinates."""
    codes = (x << 32) | y
    if weights is None:
        codes, counts = np.unique(codes, return_counts=True)
    else:
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else order
        counts = np.add.reduceat(weights[order], starts) if len(codes) else weights
        codes = codes[starts]
    return codes >> 32, codes & 0xFFFFFFFF, counts.astype(np.int64)


def count_pairs(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(x, y, counts) of the distinct pairs: dense tiles first, the others sorted."""
    near = np.flatnonzero((x < DENSE_TILES << SIDE_BITS) & (y < DENSE_TILES << SIDE_BITS))
    tiles = (x[near] >> SIDE_BITS) * DENSE_TILES + (y[near] >> SIDE_BITS)
    full = np.flatnonzero(np.bincount(tiles, minlength=1) >= DENSE)
    if not len(full):
        return sorted_pairs(x, y, weights)
    rest, parts = np.ones(len(x), bool), []
    for tile in full:
        at = near[tiles == tile]
        rest[at] = False
        # sums as floats are exact below 2^53
        parts.append(dense_tile(x[at], y[at], None if weights is None else weights[at]))
    parts.append(sorted_pairs(x[rest], y[rest], None if weights is None else weights[rest]))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def bucket_of(x: np.ndarray, y: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a pair: all pairs of a tile have the same."""
    tile = (x >> SIDE_BITS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (
        (y >> SIDE_BITS).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return ((tile ^ (tile >> np.uint64(31))) % np.uint64(buckets)).astype(np.int64)


def numbers_in(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i4").astype(np.int64)


def packed(values: np.ndarray) -> bytes:
    return values.astype("<i4").tobytes()


# -------------------------------------------------------------------- blocks
def blocks_of(docs: DataFrame, block_words: int) -> DataFrame:
    """``lang, tokens, words, counts``: blocks of texts, numbered by their own dictionaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Numbers, list]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (numbers, parts) in held.items():
                tokens = np.concatenate(parts)
                counts = np.bincount(tokens, minlength=len(numbers))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([packed(tokens)], pa.binary()),
                     pa.array([list(numbers)], pa.list_(pa.binary())),
                     pa.array([counts], pa.list_(pa.int64()))], ["lang", "tokens", "words", "counts"])
            held.clear()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if lang not in held:
                    held[lang] = Numbers(), []
                numbers, parts = held[lang]
                words = words_of(text)
                words.append(b",")
                parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= block_words:
                    yield from flush()
                    size = 0
        yield from flush()
    return docs.mapInArrow(run, "lang string, tokens binary, words array<binary>, counts array<long>")


def word_blocks(blocks: DataFrame, ranked: DataFrame, most: int) -> DataFrame:
    """``block, lang, places``: the blocks as numbers of frequent words (-1: none).

    Up to ``most`` words are broadcast; more are joined to the blocks' dictionaries."""
    if ranked.count() > most:
        return joined_word_blocks(blocks, ranked)
    known: dict[str, list[bytes]] = {}
    for lang, word in ranked.orderBy("lang", "id").select("lang", "phrase").collect():
        known.setdefault(lang, []).append(word.encode("utf-8"))
    shared = blocks.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = {lang: pa.array(words, pa.binary()) for lang, words in shared.value.items()}
        for batch in batches:
            for block, lang, tokens, words in zip(*(batch.column(c) for c in ("block", "lang", "tokens", "words")),
                                                  strict=True):
                own = sets.get(lang.as_py(), pa.array([], pa.binary()))
                # a word's number is its place among the frequent ones
                ids = pc.index_in(words.values, value_set=own).fill_null(-1).to_numpy(zero_copy_only=False).copy()
                ids[0] = -1  # the end of a piece
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()]), pa.array([lang.as_py()]),
                     pa.array([packed(ids[numbers_in(tokens.as_py())])], pa.binary())], ["block", "lang", "places"])
    return blocks.select("block", "lang", "tokens", "words").mapInArrow(
        run, "block long, lang string, places binary")


def joined_word_blocks(blocks: DataFrame, ranked: DataFrame) -> DataFrame:
    """The same for any number of frequent words."""
    own = blocks.select("block", "lang", F.posexplode("words").alias("own", "word")).where("own > 0")
    known = (own.withColumn("word", F.col("word").cast("string"))
             .join(ranked.select("lang", F.col("phrase").alias("word"), "id"), ["lang", "word"])
             .groupBy("block").agg(F.collect_list(F.struct("own", "id")).alias("known")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tokens, pairs, size in zip(batch.column("tokens").to_pylist(), batch.column("known"),
                                           batch.column("size").to_pylist(), strict=True):
                ids = np.full(size, -1, np.int64)
                own, rank = pairs.values.flatten()
                ids[own.to_numpy()] = rank.to_numpy()
                out.append(packed(ids[numbers_in(tokens)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("lang"), pa.array(out, pa.binary())], ["block", "lang", "places"])
    joined = blocks.select("block", "lang", "tokens", F.size("words").alias("size")).join(
        written(known, large_rows=True), "block")
    return joined.mapInArrow(run, "block long, lang string, places binary")


def pairs_at(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, left, right) of the neighbours that are both frequent."""
    at = np.flatnonzero((places[:-1] >= 0) & (places[1:] >= 0))
    return at, places[at], places[at + 1]


def sent_pairs(encoded: DataFrame, buckets: int, count_words: int) -> DataFrame:
    """``lang, bucket, block, x, y, n``: what blocks send to every bucket.

    A task's blocks of a language are counted together, up to about ``count_words``
    words (0: every block alone); ``block`` is the last of them."""

    def counted(lang: str, block: int, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x, y, n = count_pairs(*pairs_at(np.concatenate(parts))[1:])
        bucket = bucket_of(x, y, buckets)
        order = np.lexsort((y, x, bucket))
        bucket = bucket[order]
        x, y, n = packed(x[order]), packed(y[order]), packed(n[order])
        if not len(bucket):
            return
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        part = [[v[4 * a:4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)] for v in (x, y, n)]
        rows = len(cuts) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * rows), pa.array(bucket[cuts[:-1]], pa.int64()), pa.array([block] * rows),
             *(pa.array(p, pa.binary()) for p in part)], ["lang", "bucket", "block", "x", "y", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size, block = 0, -1
        for batch in batches:
            for block, lang, places in zip(*(batch.column(c) for c in ("block", "lang", "places")), strict=True):
                lang, block, places = lang.as_py(), block.as_py(), numbers_in(places.as_py())
                held.setdefault(lang, []).append(np.append(places, -1))
                size += len(places)
                if size >= count_words:
                    for lang, parts in held.items():
                        yield from counted(lang, block, parts)
                    held, size = {}, 0
        for lang, parts in held.items():
            yield from counted(lang, block, parts)
    return encoded.mapInArrow(run, "lang string, bucket long, block long, x binary, y binary, n binary")


def frequent_pairs(sent: DataFrame, least: int) -> DataFrame:
    """``lang, bucket, x, y, n`` of the pairs that all blocks together sent often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        held: list[tuple[np.ndarray, ...]] = []

        def added() -> tuple[np.ndarray, ...]:
            return count_pairs(*(np.concatenate(c) for c in zip(*held, strict=True)))

        def close() -> Iterator[pa.RecordBatch]:
            x, y, n = added()
            often = n >= least
            if often.any():
                rows = int(often.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([current[0]] * rows), pa.array([current[1]] * rows, pa.int64()),
                     *(pa.array(v[often], pa.int64()) for v in (x, y, n))], ["lang", "bucket", "x", "y", "n"])
        size = 0
        for batch in batches:
            for lang, bucket, x, y, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "bucket", "x", "y", "n")),
                                             strict=True):
                if current != (lang, bucket):
                    if held:
                        yield from close()
                    current, held, size = (lang, bucket), [], 0
                held.append((numbers_in(x), numbers_in(y), numbers_in(n)))
                size += len(held[-1][0])
                if size >= MERGE_PAIRS:
                    held = [added()]
                    size = len(held[0][0]) // 2  # so that few distinct pairs are not added up anew each time
        if held:
            yield from close()
    return (sent.select("lang", "bucket", "x", "y", "n").repartition("lang", "bucket")
            .sortWithinPartitions("lang", "bucket")
            .mapInArrow(run, "lang string, bucket long, x long, y long, n long"))


def pair_numbers(places: np.ndarray, codes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The number of the frequent pair at every place (-1: none); ``codes`` are sorted."""
    found = np.full(len(places), -1, np.int64)
    if len(codes):
        at, x, y = pairs_at(places)
        own = (x << 32) | y
        place = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        found[at] = np.where(codes[place] == own, ids[place], -1)
    return found


def next_blocks(encoded: DataFrame, ranked: DataFrame, buckets: int, most: int) -> DataFrame:
    """``block, lang, places``: the blocks as numbers of frequent pairs (-1: none).

    Up to ``most`` pairs are broadcast; more are told to the blocks by the buckets."""
    if ranked.count() > most:
        return told_blocks(encoded, sent_pairs(encoded, buckets, 0), ranked)
    table = ranked.select("lang", F.shiftleft("x", 32).bitwiseOR(F.col("y")).alias("code"), "id").toArrow()
    langs, codes, ids = np.array(table["lang"].to_pylist(), object), table["code"].to_numpy(), table["id"].to_numpy()
    known = {}
    for lang in set(langs):
        own = np.flatnonzero(langs == lang)
        own = own[np.argsort(codes[own])]
        known[lang] = codes[own], ids[own].astype(np.int32)
    shared = encoded.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64), np.empty(0, np.int32)
        for batch in batches:
            for block, lang, places in zip(*(batch.column(c) for c in ("block", "lang", "places")), strict=True):
                found = pair_numbers(numbers_in(places.as_py()), *shared.value.get(lang.as_py(), none))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()]), pa.array([lang.as_py()]), pa.array([packed(found)], pa.binary())],
                    ["block", "lang", "places"])
    return encoded.mapInArrow(run, "block long, lang string, places binary")


def told_blocks(encoded: DataFrame, sent: DataFrame, ranked: DataFrame) -> DataFrame:
    """The same for any number of frequent pairs.

    The frequent pairs of a bucket come before what the blocks sent to it, so a task
    holds those of one bucket and answers block by block.
    """
    both = sent.select("lang", "bucket", F.lit(1).alias("kind"), "block", "x", "y").unionByName(
        ranked.select("lang", "bucket", F.lit(0).alias("kind"), F.col("x").alias("left"), F.col("y").alias("right"),
                      "id"), allowMissingColumns=True)

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, codes, ids = None, [], np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            out = []
            for lang, bucket, kind, block, x, y, left, right, i in zip(
                    *(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if current != (lang, bucket):
                    current, rows = (lang, bucket), []
                    codes = ids = np.empty(0, np.int64)
                if kind == 0:
                    rows.append(((left << 32) | right, i))
                    continue
                if rows:
                    codes, ids = np.array(sorted(rows), np.int64).T
                    rows = []
                if len(codes):
                    own = (numbers_in(x) << 32) | numbers_in(y)
                    place = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                    hit = codes[place] == own
                    if hit.any():
                        out.append((block, own[hit].tobytes(), packed(ids[place[hit]])))
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()),
                 pa.array(columns[2], pa.binary())], ["block", "codes", "ids"])
    told = (both.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket", "kind")
            .mapInArrow(answers, "block long, codes binary, ids binary")
            .groupBy("block").agg(F.collect_list(F.struct("codes", "ids")).alias("told")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for places, told in zip(batch.column("places").to_pylist(), batch.column("told").to_pylist(), strict=True):
                codes = np.concatenate([np.frombuffer(t["codes"], np.int64) for t in told])
                ids = np.concatenate([numbers_in(t["ids"]) for t in told])
                order = np.argsort(codes)
                out.append(packed(pair_numbers(numbers_in(places), codes[order], ids[order])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("lang"), pa.array(out, pa.binary())], ["block", "lang", "places"])
    return encoded.join(written(told, large_rows=True), "block").mapInArrow(run, "block long, lang string, places binary")


def numbered(frequent: DataFrame, order: list) -> DataFrame:
    """The rows with ``id``, from 0 by falling frequency within the language."""
    ranked = rank_within_group(frequent, "lang", [F.desc("n"), *order], "place")
    out = written(ranked.withColumn("id", F.col("place") - 1).drop("place"))
    if (out.agg(F.max("id")).first()[0] or 0) >= 1 << 31:
        raise ValueError("a language has more than 2^31 frequent phrases of one length")
    return out


# ------------------------------------------------------------------- phrases
def frequent_phrases(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS,
                     block_words: int = BLOCK_WORDS, buckets: int | None = None,
                     broadcast: tuple[int, int] = (BROADCAST_WORDS, BROADCAST_PAIRS)) -> tuple[DataFrame, DataFrame]:
    """(``lang, k, phrase, n`` of all phrases of up to ``most_words`` words that occur
    ``least`` times, and ``lang, total`` words)."""
    spark = docs.sparkSession
    small_batches(spark)
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = columns_of(docs, "lang", "text").select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), text_or_empty().alias("text"))
    blocks = written(blocks_of(base, block_words).withColumn("block", F.monotonically_increasing_id()), large_rows=True)
    counts = blocks.select("lang", F.posexplode(F.arrays_zip("words", "counts")).alias("own", "w")).where("own > 0")
    words = counts.groupBy("lang", F.col("w.words").cast("string").alias("phrase")).agg(F.sum("w.counts").alias("n"))
    totals = written(blocks.groupBy("lang").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c) - F.get("counts", F.lit(0)))
        .alias("total")))
    ranked = numbered(words.where(F.col("n") >= least), ["phrase"])
    found = [ranked.withColumn("k", F.lit(1))]
    encoded = written(word_blocks(blocks, ranked, broadcast[0]), large_rows=True)
    removed(blocks)
    for k in range(2, most_words + 1):
        ranked = numbered(frequent_pairs(sent_pairs(encoded, buckets, COUNT_WORDS), least), ["x", "y"])
        if ranked.isEmpty():
            break
        parts = found[-1].select("lang", "id", "phrase")
        left = parts.select("lang", F.col("id").alias("x"), F.col("phrase").alias("left"))
        right = parts.select("lang", F.col("id").alias("y"), F.substring_index("phrase", " ", -1).alias("last"))
        found.append(written(ranked.join(left, ["lang", "x"]).join(right, ["lang", "y"]).select(
            "lang", "id", F.concat_ws(" ", "left", "last").alias("phrase"), "n", F.lit(k).alias("k"))))
        if k < most_words:
            last, encoded = encoded, written(next_blocks(encoded, ranked, buckets, broadcast[1]), large_rows=True)
            removed(last)
    out = found[0].select("lang", "k", "phrase", "n")
    for f in found[1:]:
        out = out.union(f.select("lang", "k", "phrase", "n"))
    return out, totals


def collocations(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, absorbed_at: int = 100,
                 block_words: int = BLOCK_WORDS, buckets: int | None = None,
                 broadcast: tuple[int, int] = (BROADCAST_WORDS, BROADCAST_PAIRS)) -> DataFrame:
    """One row per phrase: ``lang, phrase, k, a, l, r, n, score``.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and those
    into words at blanks and tabs; a language's null name is ``und``.  A phrase has 2 to
    ``most_words`` words of one piece and occurs ``a >= least`` times in its language,
    overlaps included; ``n`` counts all words.  Of its cuts into two parts, with
    ``l`` and ``r`` occurrences, the one with the lowest score ``floor(1000 * a * n / (l * r))``
    counts; of equal ones that with the shortest first part.  Phrases inside a longer one that
    occurs at least ``absorbed_at`` percent as often are left out.

    Null and empty texts have no words.  Texts are read whole, however long.  Repeated
    rows count each; ids are not read; an empty table gives no rows; other columns are
    ignored.
    """
    phrases, totals = frequent_phrases(docs, least, most_words, block_words, buckets, broadcast)
    phrases = written(phrases)
    longer = phrases.where("k > 1")
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    cuts = longer.select("lang", "phrase", "k", F.col("n").alias("a"),
                         F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "*", F.expr("substring_index(phrase, ' ', cut)").alias("first"),
        F.expr("substring_index(phrase, ' ', cut - k)").alias("rest"))
    for name, times in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(part.select("lang", F.col("part").alias(name), F.col("times").alias(times)), ["lang", name])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "total", "l", "r")}
    scored = cuts.join(totals, "lang").withColumns(
        {"above": wide["a"] * wide["total"] * F.lit(1000).cast("decimal(4,0)"), "below": wide["l"] * wide["r"]}
    ).withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase", "k", "a", F.col("total").alias("n")).agg(
        F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("b"))
    words = F.split("phrase", " ")
    inside = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("k") - size + 1), lambda i: F.array_join(F.slice(words, i, size), " "))))
    holders = (longer.where("k > 2").select("lang", "n", F.explode(F.array_distinct(inside)).alias("phrase"))
               .groupBy("lang", "phrase").agg(F.max("n").alias("held")))
    kept = best.join(holders, ["lang", "phrase"], "left").where(
        F.col("held").isNull() | (F.col("held") * 100 < F.col("a") * absorbed_at))
    return kept.select("lang", "phrase", "k", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n",
                       F.col("b.score").alias("score"))


def first_of_each(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best phrases of every language, with ``rank`` from 1: by score and
    ``a``, highest first, then by phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)


ship(__name__)
