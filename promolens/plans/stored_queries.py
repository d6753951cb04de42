"""Registered queries that write tables, lists and snapshots to the shared
checkpoint folder and read them back, and those over datasets of runs and raw
model answers. ``oracle_stored.py`` gives their results in SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions.analysis import analysed, load_model_output
from ..functions.extract import extract_analysis_json
from ..functions.text import keyword_match
from ..operators import discovery
from ..session import checkpoint_dir
from ..sources import discounts as disc
from ..sources import posts as P
from ..sources.tables import caption_days
from . import driver as D
from . import jobs
from .queries import QUERIES, _discovery
from .source_queries import coded_captions, dump_files, register, text_lines
from .source_queries import _records as dump_records

__all__ = ["QUERIES"]

DAYS = (dt.datetime(2025, 3, 1, 8), dt.datetime(2025, 3, 2, 8))
KEYWORDS = ("code", "korting")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# -------------------------------------------------------- model answers --

@register
def x2_model_output(spark, sf_dir):
    """Answers that are no JSON, or JSON null, leave a row unanalysed; white space
    around an answer, non-ASCII text and nulls inside it are kept apart from that."""
    k, n = F.col("doc_id") % 7, F.col("doc_id").cast("string")
    raw = (F.when(k == 0, F.concat(F.lit('[{"webshop":"w'), n, F.lit('"')))
           .when(k == 1, F.lit(None).cast("string"))
           .when(k == 2, F.concat(F.lit('  [{"webshop":"café ünï €'), n, F.lit('","code":null}] ')))
           .when(k == 3, F.lit("null")).when(k == 4, F.lit("[]")).when(k == 5, F.lit("sorry, no codes"))
           .otherwise(F.concat(F.lit('{"b":1.5,"a":['), n, F.lit(",true]}"))))
    answers = D.table(spark, sf_dir, "documents").select("doc_id", load_model_output(raw).alias("v"))
    return answers.select("doc_id", F.to_json("v").alias("analysis"), F.col("v").isNotNull().alias("analysed"))


def coded_posts(spark, sf_dir) -> DataFrame:
    """Posts whose captions hold codes; many share their url and caption."""
    posts = D.posts(spark, sf_dir).drop("caption")
    codes = coded_captions(spark, sf_dir)
    return posts.join(codes, posts["ord"] == codes["doc_id"]).drop("doc_id")


@register
def j2_coded_attach(spark, sf_dir):
    """J2/K3 (P5, X1, X2, F17): analyses with codes, shops and amounts are set on every row with
    the same platform, url and caption."""
    posts = coded_posts(spark, sf_dir)
    table = posts.select(F.col("ord").alias("id"), "platform", "caption", "post_url",
                         F.lit(None).cast("string").alias("ai_analysis"),
                         F.lit(None).cast("timestamp").alias("ai_analysis_time"))
    raw = posts.where(keyword_match("caption", KEYWORDS) & (F.col("ord") % 2 == 0)).withColumn(
        "raw", extract_analysis_json("caption"))
    updates = analysed(raw.select("platform", "post_url", "caption", "ord", "raw"))
    return sinks.apply_analysis(table, updates, D.TODAY_TS).select(
        "id", "ai_analysis", F.col("ai_analysis_time").isNotNull().alias("analysed"))


# ---------------------------------------------------------- stored tables --

def two_days(spark, sf_dir) -> jobs.Warehouse:
    """A warehouse after two daily runs; the second brings all posts, those of the first again."""
    wh = jobs.Warehouse(scratch(spark, "archive"), scratch(spark, "captions"))
    posts = coded_posts(spark, sf_dir)
    for now, some in zip(DAYS, (posts.where(F.col("ord") % 3 == 0), posts), strict=True):
        jobs.caption_ingest(spark, some, wh, now, KEYWORDS)
        jobs.analysis_attach(spark, wh, now.date(), None, now)
    return wh


@register
def e8_two_days(spark, sf_dir):
    """E8 (E1, E2; K1, K2, K3, J2, J5 on stored tables): the caption table after two runs."""
    wh = two_days(spark, sf_dir)
    return wh.captions(spark).select(
        "platform", "post_url", "caption", F.to_date("inserted_at").alias("inserted_on"), "ai_analysis",
        F.to_date("ai_analysis_time").alias("analysed_on"))


@register
def e8_archive(spark, sf_dir):
    """E8 (E1, K1): the archive after two runs; day two sees what day one stored."""
    wh = two_days(spark, sf_dir)
    return spark.read.parquet(wh.archive).select("platform", "post_url", "caption")


@register
def s12_stored_days(spark, sf_dir):
    """One platform's rows of one insert day, read from its partitions alone."""
    wh = two_days(spark, sf_dir)
    day = DAYS[1].date()
    return caption_days(spark, wh.captions_path, day, day, "instagram").select("post_url", "caption", "ai_analysis")


# --------------------------------------------------- runs and old dumps ----

@register
def s9_run_posts(spark, sf_dir):
    """Posts of the datasets of successful runs, by run rank; some runs have no dataset."""
    files = dump_files(spark, sf_dir)
    conv = F.regexp_extract("file", r"([0-9]+)$", 1).cast("long")
    raw = files.select(F.format_string("/sets/d%d.json", conv).alias("file"), "value")
    runs = D.table(spark, sf_dir, "conversations").select("conv_id").distinct().select(
        F.format_string("r%09d", "conv_id").alias("run_id"),
        F.format_string("2025-01-%02dT00:00:00Z", F.col("conv_id") % 28 + 1).alias("startedAt"),
        F.when(F.col("conv_id") % 4 == 1, "FAILED").otherwise("SUCCEEDED").alias("status"),
        F.when(F.col("conv_id") % 5 == 2, "").when(F.col("conv_id") % 7 == 3, F.lit("gone"))
        .otherwise(F.format_string("d%d", "conv_id")).alias("defaultDatasetId"))
    return P.posts_of_runs(raw, P.successful_runs(runs), "instagram").select(
        "run_rank", "platform", "influencer_name", "caption", "post_url", "post_date")


@register
def s8_mentions(spark, sf_dir):
    """Tagged posts of archived files that have a url."""
    return P.mentions_of(dump_records(spark, sf_dir)).select(
        "platform", "influencer_name", "caption", "post_url", "post_date")


# ------------------------------------------------------------- list files --

@register
def s18_bracket_batches(spark, sf_dir):
    """Batches between the brackets of list files that hold an array."""
    lines = text_lines(spark, sf_dir)
    p = F.col("pos")
    line = (F.when(p % 13 == 3, F.lit(" [ ")).when(p % 11 == 10, F.concat(F.col("line"), F.lit(" ],")))
            .otherwise(F.col("line")))
    return disc.batches_from_lines(lines.withColumn("line", line), bracket_rules=True).select(
        "file", "batch_no", "pos", "line")


@register
def k5_sorted_names(spark, sf_dir):
    """K5 + O5: the known names, sorted, written as text files and read back in order."""
    names = disc.known_names(D.published_lines(spark, sf_dir), D.table(spark, sf_dir, "events"), "props")
    customers = D.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    path = scratch(spark, "names")
    sinks.write_lines(names.union(customers).distinct().withColumn("line", F.col("name")), path, "name")
    return sinks.read_ordered(spark, path)


@register
def k6_seed_list(spark, sf_dir):
    """K6 + O6: the seed list after a sample was added twice under one run id."""
    path, log = scratch(spark, "seed"), scratch(spark, "added")
    old = D.table(spark, sf_dir, "supplier").select(F.concat(F.lit(" https://old/"), "s_name").alias("url"))
    sinks.append_seed_urls(old, path, log, "first")
    room = D.table(spark, sf_dir, "customer").count() // 10
    existing = D.table(spark, sf_dir, "supplier").count()
    urls = discovery.sample_new_users(_discovery(spark, sf_dir), existing + room, existing, D.SEED)
    for _ in range(2):
        sinks.append_seed_urls(urls, path, log, "second")
    return P.seed_list(spark, path).select("value")


@register
def k7_latest_snapshot(spark, sf_dir):
    """K7: the records of the newest of two snapshots, read back."""
    root = scratch(spark, "snapshots")
    records = dump_records(spark, sf_dir).select("file", F.to_json("rec").alias("record"))
    even = F.col("file").substr(-1, 1).cast("int") % 2 == 0
    sinks.snapshot_json(records.where(even).select("record"), root, "big", DAYS[0])
    sinks.snapshot_json(records.where(~even).select("record"), root, "big", DAYS[1])
    sinks.snapshot_json(records.select("record"), root, "small", DAYS[1])
    found = sinks.latest_snapshot(spark, root, "big").select(F.parse_json("record").alias("r"))
    return found.select(F.try_variant_get("r", "$.url", "string").alias("url"),
                        F.try_variant_get("r", "$.caption", "string").alias("caption"),
                        F.try_variant_get("r", "$.username", "string").alias("username"))
