"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is cut where its own content says so (after the end of a sentence, at
least ``MIN_CHUNK`` characters on; after ``MAX_CHUNK`` characters otherwise).
Every chunk gets an identifier by hash, and the identifiers are verified: the
distinct chunk texts are compared themselves, and if two different chunks share
an identifier, wider or differently seeded identifiers are tried until none do.
From then on only the ordered identifier lists ("recipes") travel; equal lists
are equal texts.  Long texts are moved once, as distinct chunks, after a
map-side distinct; a hot chunk or a hot group is one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, columns_of, text_or_empty, written

#: Fewest and most characters of a chunk; a text's last chunk may be shorter.
MIN_CHUNK, MAX_CHUNK = 256, 2048

#: Widest identifier: two 64-bit hashes.
FULL_BITS = 128


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space."""
    return F.regexp_replace(text, BLANKS + r"{2,}|[\x09-\x0D]", " ")


def chunks_of(text: Column, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> Column:
    """Chunks whose concatenation is the text; none for the empty text."""
    pattern = rf"(?s).{{{low},{high}}}?[.!?] |.{{1,{high}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_id(chunk: Column, bits: int, seed: int) -> Column:
    """Identifier of a chunk: the low ``bits`` of two seeded 64-bit hashes."""
    def lane(k: int, width: int) -> Column:
        h = F.xxhash64(F.lit(2 * seed + k), chunk)
        return h if width >= 64 else h.bitwiseAND(F.lit((1 << width) - 1))
    return F.struct(lane(0, min(bits, 64)).alias("a"),
                    (lane(1, bits - 64) if bits > 64 else F.lit(0).cast("long")).alias("b"))


def has_collision(chunks: DataFrame, bits: int, seed: int) -> bool:
    """Do two different chunk texts (column ``chunk``) share an identifier?"""
    ids = chunks.select(chunk_id(F.col("chunk"), bits, seed).alias("id"), "chunk").distinct()
    return not ids.groupBy("id").count().where("count > 1").isEmpty()


def verified_width(chunks: DataFrame, bits: int = FULL_BITS) -> tuple[int, int]:
    """(bits, seed) under which every distinct chunk has its own identifier."""
    seed = 0
    while has_collision(chunks, bits, seed):
        bits, seed = (bits * 2, seed) if bits < FULL_BITS else (FULL_BITS, seed + 1)
        bits = min(bits, FULL_BITS)
    return bits, seed


def exact_dedup(docs: DataFrame, bits: int = FULL_BITS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical after every run of white space has
    become one space; the row with the smallest ``doc_id`` of equal texts stays.
    A null text counts as empty, and all empty texts are equal.  Rows with a
    null ``doc_id`` count in ``group_size`` and stay only if the whole group has
    none.  Repeated rows of one ``doc_id`` and text get the same verdict.  An
    empty table gives no rows; other columns are ignored.
    """
    base = columns_of(docs, "doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    texts = base.select("doc_id", normalised(F.col("text")).alias("norm"))
    bits, seed = verified_width(
        texts.select(F.explode(chunks_of(F.col("norm"))).alias("chunk")), bits)
    # both sides of the join are written, so that a recipe with very many rows can be split
    recipes = written(texts.select(
        "doc_id",
        F.transform(chunks_of(F.col("norm")), lambda c: chunk_id(c, bits, seed)).alias("recipe"),
        F.sha2(F.col("norm"), 256).alias("text_sha256")))
    groups = written(recipes.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"),
                                                   F.count(F.lit(1)).alias("group_size")))
    return recipes.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
