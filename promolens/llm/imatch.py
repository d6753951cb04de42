"""I-Match fingerprints (DataFrame functions only).

The lexicon holds the terms whose document frequency lies in a chosen band, as
shares of all documents.  Its size is bounded whatever the corpus: a term in at
least a share ``low`` of the documents leaves room for at most
``mean distinct terms of a document / low`` such terms.  Only that lexicon
reaches the driver; it goes back as a literal of hash buckets, so that a term is
looked up in constant time.  A document keeps its distinct lexicon terms, sorted;
for each of several random subsets of the lexicon, those of its terms in the
subset are hashed in order.  The subsets get sparser, so that long texts with
few changes still share some hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .common import columns_of, text_or_empty

#: Band of document frequency, as shares of all documents.
BAND = (0.005, 0.1)
#: Share of the lexicon in each random subset, as 1 / n.
SUBSETS = (1, 2, 4, 8, 16, 32, 64, 64, 128, 128)
#: Hash buckets of the lexicon literal.
BUCKETS = 1 << 14


def terms_of(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def lexicon_of(docs: DataFrame, band: tuple[float, float] = BAND) -> list[str]:
    """The terms whose document frequency lies in the band."""
    n = docs.count()
    counts = (docs.select(F.explode(terms_of(text_or_empty())).alias("term"))
              .groupBy("term").count())
    inside = counts.where((F.col("count") >= band[0] * n) & (F.col("count") <= band[1] * n))
    return [r[0] for r in inside.select("term").collect()]  # bounded, see above


def lookup_literal(spark, lexicon: list[str], buckets: int = BUCKETS) -> Column:
    """Array of ``buckets`` strings `` term term `` by the terms' hash bucket."""
    rows = spark.createDataFrame([(t,) for t in lexicon], "term string")
    by = rows.groupBy(F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("b")).agg(
        F.concat_ws(" ", F.collect_list("term")).alias("terms")).collect()
    table = [""] * buckets
    for b, terms in by:
        table[b] = f" {terms} "
    return F.split(F.lit("|".join(table)), r"\|", -1)


def kept_terms(terms: Column, lookup: Column, buckets: int = BUCKETS) -> Column:
    """The lexicon terms among distinct terms, sorted."""
    return F.sort_array(F.filter(terms, lambda t: F.contains(
        F.get(lookup, F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int")),
        F.concat(F.lit(" "), t, F.lit(" ")))))


def subset_hashes(terms: Column, subsets: tuple[int, ...] = SUBSETS) -> Column:
    """One hash for each random subset of the lexicon; `-` where it has no term."""
    def one(k: int, n: int) -> Column:
        mine = F.filter(terms, lambda t: F.pmod(F.xxhash64(F.lit(k), t), F.lit(n)) == 0) if n > 1 else terms
        return F.when(F.size(mine) == 0, F.lit("-")).otherwise(
            F.lpad(F.lower(F.hex(F.xxhash64(F.lit(k), mine))), 16, "0"))
    return F.array(*[one(k, n) for k, n in enumerate(subsets)])


def with_fingerprint(df: DataFrame, source: str, name: str, lookup: Column,
                     subsets: tuple[int, ...] = SUBSETS) -> DataFrame:
    """Adds column ``name``: the hashes of column ``source`` joined by colons.

    A text without lexicon terms has the hashes of all its own terms, marked by
    ``~``; one without any term is named by its own hash.  Each step is a column
    of its own, so that no step is computed once per use.
    """
    every, kept, terms, hashes = (f"{name}_{x}" for x in ("every", "kept", "terms", "hashes"))
    bare = F.size(kept) == 0
    return (df.withColumn(every, terms_of(F.col(source)))
            .withColumn(kept, kept_terms(F.col(every), lookup))
            .withColumn(terms, F.when(bare, F.sort_array(every)).otherwise(F.col(kept)))
            .withColumn(hashes, subset_hashes(F.col(terms), subsets))
            .withColumn(name, F.when(F.size(terms) == 0, F.concat(F.lit("="), F.sha2(source, 256)))
                        .otherwise(F.concat(F.when(bare, "~").otherwise(""), F.concat_ws(":", hashes))))
            .drop(every, kept, terms, hashes))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets in which either text has terms."""
    pairs = F.arrays_zip(F.split(a, ":").alias("a"), F.split(b, ":").alias("b"))
    used = F.size(F.filter(pairs, lambda p: ~((p["a"] == "-") & (p["b"] == "-"))))
    same = F.size(F.filter(pairs, lambda p: (p["a"] == p["b"]) & (p["a"] != "-")))
    return (F.when(a == b, F.lit(1.0))
            .when(a.startswith("=") | b.startswith("="), F.lit(0.0))
            .otherwise(same / used))


def with_next(docs: DataFrame) -> tuple[DataFrame, WindowSpec]:
    """Adds ``next_text``: the text of the next document by descending ``doc_id``.

    After the last comes the first.  Ids are cut into ranges at quantiles; the
    highest id of a range is copied into the range above (column ``closing``),
    so that one shuffle of the texts is enough and no task gets more than a
    range.  Equal ids are ordered by text; null ids come last, as one range.
    Also returns the window that orders a range.
    """
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    doc_id = F.col("doc_id")
    quantiles, high, nulls = docs.agg(
        F.percentile_approx("doc_id", [(k + 1) / parts for k in range(parts)], 10000),
        F.max("doc_id"), F.count_if(doc_id.isNull())).first()
    bounds = sorted({*quantiles, high}) if quantiles else []
    # range k holds the ids in (bounds[k-1], bounds[k]]; the nulls are range -1
    highs = F.array(*[F.lit(int(b)).cast("long") for b in bounds]).cast("array<long>")
    lowest = -1 if nulls else 0
    own = F.when(doc_id.isNull(), -1).otherwise(F.size(F.filter(highs, lambda b: b < doc_id)))
    above = (F.when(doc_id.isNull(), 0 if bounds else -1)
             .when(F.col("own") == len(bounds) - 1, lowest).otherwise(F.col("own") + 1))

    def place(at: Column, closing: bool) -> Column:
        return F.struct(at.alias("range"), F.lit(closing).alias("closing"))
    rows = (docs.withColumn("own", own)
            .withColumn("place", F.explode(
                F.when(doc_id.isNull() | F.array_contains(highs, doc_id),
                       F.array(place(F.col("own"), False), place(above, True)))
                .otherwise(F.array(place(F.col("own"), False)))))
            .select("doc_id", "text", "place.range", "place.closing"))
    order = Window.partitionBy("range").orderBy("closing", F.desc_nulls_last("doc_id"), "text")
    return rows.withColumn("next_text", F.lead("text").over(order)), order


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND,
                 subsets: tuple[int, ...] = SUBSETS) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by
    the first as many (or all) of the next document, by descending ``doc_id``.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.  A null text counts as empty; a text without
    lexicon terms has a fingerprint of all its own terms (after ``~``), and one
    without any term that of its own hash, so that equal texts always have equal
    fingerprints and other texts without terms are unlike.  Repeated rows each
    count as a document; null ids come last.  An empty table gives no rows;
    other columns are ignored.
    """
    base = columns_of(docs, "doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    lookup = lookup_literal(base.sparkSession, lexicon_of(base, band))
    rows, order = with_next(base)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), n - half),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)))

    rows = with_fingerprint(rows, "text", "fingerprint", lookup, subsets)
    rows = with_fingerprint(rows, "edited", "edited_fingerprint", lookup, subsets)
    marked = rows.select("range", "closing", "doc_id", "text", n.cast("long").alias("n_chars"),
                         F.sha2("edited", 256).alias("edited_sha256"),
                         "fingerprint", "edited_fingerprint")
    return (marked.withColumn("next_fp", F.lead("fingerprint").over(order))
            .where(~F.col("closing"))
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fp")).alias("near_next")))
