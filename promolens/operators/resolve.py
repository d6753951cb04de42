"""Webshop name resolution (J6) and canonical attach.

J6 maps each spelling to the closest known key, else ``UNKNOWN``. Both
sides are normalised to ``[a-z0-9]``; a candidate scores

* 3 when the normalised texts are equal,
* 2 when one is a prefix of the other and the prefix has >= 4 characters,
* 1 when the Levenshtein similarity ``1 - lev / max_len`` is >= 0.8,

and the best candidate wins (score, then smaller ``lev / max_len``, then the
key). Candidates come from three equi-joins, never from all pairs:

* exact: on the normalised text;
* prefix: each side emits its own prefixes of length >= 4, joined to the
  other side's full text;
* edit distance: bigram prefix filtering. A pair with similarity >= 0.8
  shares at least ``ceil(0.6 * len - 1)`` bigrams (count filter with
  ``d <= 0.2 * max_len``), so each string only needs to index its rarest
  ``len - 1 - tau + 1`` bigrams (occurrence-numbered, ordered by global
  frequency) and every qualifying pair shares one of them. Strings shorter
  than 4 characters can only match exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import analysis as A
from .dedup import first_per_key
from ..session import checkpoint_dir

MIN_PREFIX = 4
UNKNOWN = "UNKNOWN"


def normalise_name(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def _prefixes(col: str) -> Column:
    """All prefixes of length >= MIN_PREFIX (rows must be that long)."""
    n = F.col(col)
    return F.explode(F.transform(F.sequence(F.lit(MIN_PREFIX), F.length(n)), lambda i: F.substr(n, F.lit(1), i)))


def _numbered_bigrams(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, gram) with grams numbered by occurrence (multiset semantics),
    counted inside the string's own array."""
    t = F.col(text_col)
    pairs = F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substr(t, i, F.lit(2)))
    grams = df.select(id_col, text_col, pairs.alias("gs"))

    def numbered(g: Column, i: Column) -> Column:
        earlier = F.filter(F.slice("gs", 1, i + 1), lambda x: x == g)
        return F.concat(g, F.lit("#"), F.size(earlier).cast("string"))
    return grams.select(id_col, text_col, F.explode(F.transform("gs", numbered)).alias("gram"))


def _gram_prefix(grams: DataFrame, freq: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Keep each string's ``len - tau`` rarest grams (``tau`` = required
    overlap lower bound from its own length)."""
    g = grams.join(freq, "gram")
    rank = F.row_number().over(Window.partitionBy(id_col).orderBy("freq", "gram"))  # one string's grams
    length = F.length(text_col)
    tau = F.ceil(F.lit(0.6) * length - F.lit(1.0))
    keep = (length - F.lit(1)) - tau + F.lit(1)
    return g.withColumn("_r", rank).where(F.col("_r") <= keep).select(id_col, "gram")


def resolve_names(unknown: DataFrame, keys: DataFrame, name_col: str = "name",
                  key_col: str = "key") -> DataFrame:
    """(name, canonical, score) for every distinct input name."""
    # both distinct lists feed every candidate arm: written once to the
    # shared checkpoint folder instead of recomputing their upstream per arm
    checkpoint_dir(unknown.sparkSession)
    u = (unknown.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct()
         .withColumn("n", normalise_name("name")).checkpoint(eager=True))
    k = (keys.select(F.col(key_col).alias("key")).where(F.col("key").isNotNull()).distinct()
         .withColumn("kn", normalise_name("key")).where(F.col("kn") != "").checkpoint(eager=True))
    us = u.where(F.col("n") != "")

    exact = us.join(k, us.n == k.kn).select("name", "key", "n", "kn")
    key_is_prefix = (us.where(F.length("n") >= MIN_PREFIX).select("name", "n", _prefixes("n").alias("p"))
                     .join(k, F.col("p") == F.col("kn")).select("name", "key", "n", "kn"))
    # of the keys that begin with one text the shortest, then smallest, is nearest to it
    by_prefix = (k.where(F.length("kn") >= MIN_PREFIX).select("key", "kn", _prefixes("kn").alias("p"))
                 .groupBy("p").agg(F.min(F.struct(F.length("kn").alias("len"), "key", "kn")).alias("best"))
                 .select("p", "best.key", "best.kn"))
    name_is_prefix = by_prefix.join(us, F.col("p") == F.col("n")).select("name", "key", "n", "kn")

    ug = _numbered_bigrams(us.where(F.length("n") >= MIN_PREFIX), "name", "n")
    kg = _numbered_bigrams(k.where(F.length("kn") >= MIN_PREFIX), "key", "kn")
    freq = ug.select("gram").unionByName(kg.select("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("freq"))
    up = _gram_prefix(ug, freq, "name", "n")
    kp = _gram_prefix(kg, freq, "key", "kn")
    fuzzy = (up.join(kp, "gram").select("name", "key").distinct()
             .join(us, "name").join(k, "key").select("name", "key", "n", "kn"))

    cands = exact.unionByName(key_is_prefix).unionByName(name_is_prefix).unionByName(fuzzy)
    lev = F.levenshtein("n", "kn")
    maxlen = F.greatest(F.length("n"), F.length("kn"))
    shorter = F.least(F.length("n"), F.length("kn"))
    is_prefix = (F.col("n").startswith(F.col("kn")) | F.col("kn").startswith(F.col("n"))) & (shorter >= MIN_PREFIX)
    score = (F.when(F.col("n") == F.col("kn"), 3)
             .when(is_prefix, 2)
             .when(F.lit(5) * lev <= maxlen, 1))
    scored = (cands.withColumn("score", score).where(F.col("score").isNotNull())
              .withColumn("dist", lev / maxlen)
              .select("name", "key", "score", "dist"))
    best = first_per_key(scored.withColumn("neg", -F.col("score")), ["name"], ["neg", "dist", "key"])
    return (u.join(best, "name", "left")
            .select("name", F.coalesce("key", F.lit(UNKNOWN)).alias("canonical"),
                    F.coalesce("score", F.lit(0)).alias("score")))


def attach_canonical(captions: DataFrame, mapping: DataFrame) -> DataFrame:
    """For rows without canonical name, the canonical of the first
    mapping entry (by name) whose name equals one of the row's webshops (exact, case-sensitive); ``UNKNOWN`` is stored too.

    Returns (id, ai_canonical) of the rows that change. The mapping is
    joined to the exploded entries (AQE broadcasts it when small); the pick
    per row is a hash aggregate."""
    entries = A.parse_list("ai_analysis")
    rows = (captions.where(F.col("ai_canonical").isNull())
            .select("id", F.explode_outer(A.entry_fields(entries)).alias("e")).where(F.col("e").isNotNull()))
    rows = A.entry_texts(rows, "e").select("id", "webshop")
    return attach_canonical_entries(rows, mapping)


def attach_canonical_entries(entries: DataFrame, mapping: DataFrame) -> DataFrame:
    """J3 over already exploded (id, webshop) entries of unresolved rows."""
    rows = entries.select("id", F.col("webshop").alias("name")).where(F.col("name").isNotNull())
    hits = rows.join(mapping.select("name", "canonical"), "name")
    return hits.groupBy("id").agg(F.min_by("canonical", "name").alias("ai_canonical"))


def rows_per_canonical(updates: DataFrame) -> DataFrame:
    """A10: updated rows per canonical name."""
    return updates.groupBy("ai_canonical").agg(F.count(F.lit(1)).alias("updated"))
