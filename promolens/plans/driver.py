"""Inputs of the library derived from the benchmark tables.

The benchmark tables hold no captions, so each input the jobs expect is
derived from them by a fixed rule (documented per view). The DuckDB oracle
(``plans/oracle.py``) derives the same inputs with the same rules.

* ``captions``: one caption-table row per order (orders ⋈ customer), with an
  analysis list built from the order's line items (⋈ part).
* ``published_lines``: the published-discount list, one line per returned
  and finished line item, newest ship date first.
* ``posts``: raw posts for ingest, one per document.
* ``history``: archive batches of brands, one batch per 100 order keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Parameters of the derived inputs and of the jobs run on them.
REPORT_CUTOFF = dt.datetime(1997, 6, 30, 12, 0, 0)
ANALYSIS_DAY = dt.date(1998, 3, 14)
POST_DATE_AFTER = dt.datetime(1998, 3, 1)
TODAY = dt.date(2001, 6, 30)
TODAY_TS = dt.datetime(2001, 6, 30, 9, 0, 0)
SEED = 7
PUBLISH_RULES = dict(
    ignored_brands=("brand#13",),
    min_code_length={"brand#7": 9},
    default_values={"brand#5": "15"},
    boosted_brands=("brand#3",),
)
DISCOVERY_BRANDS = ("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6")
KNOWN_SINCE = dt.datetime(2001, 1, 1)
INGEST_KEYWORDS = ("réduction", "rabatt", "thor", "eaux", "cher ", "mientras")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pct() -> F.Column:
    return F.col("l_quantity").cast("int")


def line_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysis entries per line item: webshop = brand, code = TYPE+qty,
    percentage = qty; some fields are JSON null by return flag/status."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    j = li.join(part, li.l_partkey == part.p_partkey)
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return j.select(
        "*",
        F.when((rf == "N") & (ls == "O"), F.lit(None)).otherwise(F.col("p_brand")).alias("e_webshop"),
        F.when((rf == "R") & (ls == "O"), F.lit(None))
        .otherwise(F.concat(F.upper("p_type"), _pct().cast("string"))).alias("e_code"),
        F.when((rf == "N") & (ls == "F"), F.lit(None)).otherwise(_pct()).alias("e_pct"),
    )


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption table: id, platform, influencer_name, caption, post_url,
    post_date, inserted_at, ai_analysis, ai_canonical, ai_analysis_time.

    The per-order list is bounded by the order's line items (an analysis
    list is one caption's codes).
    """
    e = line_entries(spark, sf_dir)
    entry = F.struct(F.col("e_webshop").alias("webshop"), F.col("e_code").alias("code"),
                     F.col("e_pct").alias("percentage"))
    per_order = (e.groupBy("l_orderkey")
                 .agg(F.sort_array(F.collect_list(F.struct(
                     "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                     entry.alias("entry"), F.col("p_brand").alias("brand")))).alias("items")))
    # the text is made after the join: once per order, and only of orders that are read
    per_order = per_order.select("l_orderkey", F.col("items.entry").alias("entries"),
                                 F.get(F.col("items"), 0)["brand"].alias("first_brand"))
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = (orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
         .join(per_order, orders.o_orderkey == per_order.l_orderkey, "left"))
    with_nulls = {"ignoreNullFields": "false"}
    analysis = (F.when(F.col("entries").isNull(), F.lit(None))
                .when(F.col("o_orderpriority") == "5-LOW", F.to_json(F.get(F.col("entries"), 0), with_nulls))
                .otherwise(F.to_json("entries", with_nulls)))
    canonical = (F.when(F.col("o_orderstatus") == "F", F.lit(None))
                 .when(F.col("o_orderstatus") == "O", F.lit("UNKNOWN"))
                 .otherwise(F.lower("first_brand")))
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "tiktok").otherwise("instagram").alias("platform"),
        F.col("c_name").alias("influencer_name"),
        F.concat_ws(" ", F.lit("order"), "o_orderpriority", "o_orderstatus").alias("caption"),
        F.concat(F.lit("https://shop.example/p/"), F.col("o_custkey").cast("string")).alias("post_url"),
        F.col("o_orderdate").alias("post_date"),
        F.col("o_orderdate").alias("inserted_at"),
        analysis.alias("ai_analysis"),
        canonical.alias("ai_canonical"),
        F.lit(None).cast("timestamp").alias("ai_analysis_time"),
    )


def published_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published list as (ord, line): ``brand (promo size), CODE, pct, x, MM-dd``
    for returned ('A') and finished ('F') items, newest ship date first."""
    e = line_entries(spark, sf_dir).where((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"))
    line = F.concat(F.lower("p_brand"), F.lit(" (promo "), F.col("p_size").cast("string"), F.lit("), "),
                    F.upper("p_type"), _pct().cast("string"), F.lit(", "), _pct().cast("string"),
                    F.lit(", x, "), F.date_format("l_shipdate", "MM-dd"))
    ord_ = F.struct(F.datediff(F.lit("2100-01-01"), F.col("l_shipdate")).alias("age"),
                    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return e.select(ord_.alias("ord"), line.alias("line"))


def history_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive batches (file, batch_no, pos, line): 100 order keys per
    batch, items in key order, line = ``"Brand, code"``."""
    e = line_entries(spark, sf_dir)
    return e.select(F.lit("archive").alias("file"),
                    (F.col("l_orderkey") / 100).cast("long").alias("batch_no"),
                    F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             "l_extendedprice").alias("pos"),
                    F.concat(F.lit('"'), F.col("p_brand"), F.lit(", "), F.coalesce("e_code", F.lit("None")),
                             F.lit('"')).alias("line"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts for ingest: (platform, influencer_name, caption, post_url,
    post_date, ord); exact copies of a text share a post key."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.when(F.col("lang").isin("en", "de"), "instagram").otherwise("tiktok").alias("platform"),
        F.col("source").alias("influencer_name"),
        F.col("text").alias("caption"),
        F.concat(F.lit("https://post/"), (F.col("n_chars") % 50).cast("string")).alias("post_url"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("post_date"),
        F.col("doc_id").alias("ord"),
    )
