"""Sinks (K1-K7).

Tables are Parquet folders partitioned by ``platform`` (the caption table also
by insert day). Inserts are
"insert-ignore" appends: an anti-join against the key columns of the table. Updates (K3, K4) rewrite only the days of the caption table that hold an
updated row. The caption table has versions (``sources/versions.py``): no file is ever
overwritten, and a write is seen whole or not at all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import key_prefix
from .operators.dedup import first_per_key
from .operators.ingest import first_per_post
from .operators.ordering import global_rank
from .session import checkpoint_dir
from .sources import versions
from .sources.tables import (ARCHIVE_SCHEMA, CAPTION_PARTITIONS, CAPTION_SCHEMA, child_names, path_exists,
                             read_table)
from .sources.versions import read_version

POST_KEY = ["platform", "post_url", "caption_key"]


def _keys(df: DataFrame) -> DataFrame:
    """Post keys of a table; the archive stores ``caption_key`` (only the
    key columns are scanned), the caption table derives it."""
    if "caption_key" in df.columns:
        return df.select("platform", "post_url", "caption_key")
    return df.select("platform", "post_url", key_prefix("caption").alias("caption_key"))


def not_yet_stored(records: DataFrame, table: DataFrame) -> DataFrame:
    """J5 (+W1): the first record of every post key that the table lacks."""
    batch = first_per_post(records).withColumn("caption_key", key_prefix("caption"))
    return batch.join(_keys(table), POST_KEY, "left_anti")


def archive_rows(records: DataFrame, archive: DataFrame) -> DataFrame:
    """K1: the archive rows that ``records`` = (platform, influencer_name,
    caption, post_url, post_date, ord) add to the archive."""
    return not_yet_stored(records, archive).select(
        "influencer_name", "caption", "post_url", F.col("post_date").cast("timestamp").alias("post_date"),
        "caption_key", "platform")


def caption_rows(records: DataFrame, table: DataFrame, now: dt.datetime) -> DataFrame:
    """K2: the caption-table rows that the keyword ``records`` add, with
    ``inserted_at = now`` and ids after the current maximum."""
    max_id = table.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    ranked = global_rank(not_yet_stored(records, table), ["platform", "ord"], "_r")
    return ranked.select(
        (F.col("_r") + F.lit(max_id)).cast("long").alias("id"), "influencer_name", "caption", "post_url",
        F.col("post_date").cast("timestamp").alias("post_date"),
        F.lit(now).cast("timestamp").alias("inserted_at"),
        F.lit(None).cast("string").alias("ai_analysis"), F.lit(None).cast("string").alias("ai_canonical"),
        F.lit(None).cast("timestamp").alias("ai_analysis_time"), "platform",
        F.to_date(F.lit(now).cast("timestamp")).alias("inserted_on"))


def insert_archive(spark: SparkSession, records: DataFrame, archive_path: str) -> DataFrame:
    """K1: append the posts not yet archived. Returns the appended rows."""
    new = archive_rows(records, read_table(spark, archive_path, ARCHIVE_SCHEMA))
    # materialise in the shared checkpoint folder before appending: the
    # anti-join must see the table as it was before this insert
    checkpoint_dir(spark)
    new = new.checkpoint(eager=True)
    new.write.mode("append").partitionBy("platform").parquet(archive_path)
    return new


def insert_captions(spark: SparkSession, records: DataFrame, table_path: str,
                    now: dt.datetime) -> DataFrame:
    """K2: append keyword captions not yet in the caption table."""
    out = caption_rows(records, read_version(spark, table_path, CAPTION_SCHEMA), now)
    checkpoint_dir(spark)
    out = out.checkpoint(eager=True)
    versions.append(out, table_path, CAPTION_PARTITIONS)
    return out


def apply_analysis(table: DataFrame, updates: DataFrame, now: dt.datetime) -> DataFrame:
    """K3 + J2: set ``ai_analysis`` and ``ai_analysis_time`` on every row
    with the update's ``post_url`` and caption key (F2; a NULL
    caption never matches). ``updates`` = (platform, post_url, caption,
    ai_analysis, ord); the last update per key wins."""
    keyed = updates.withColumn("caption_key", key_prefix("caption"))
    last = first_per_key(keyed.select(*POST_KEY, "ai_analysis", "ord"), POST_KEY, ["ord"], last=True)
    upd = last.select(*POST_KEY, F.col("ai_analysis").alias("_new"))
    t = table.withColumn("caption_key", key_prefix("caption"))
    joined = t.join(upd, POST_KEY, "left")
    hit = F.col("_new").isNotNull()
    return (joined.withColumn("ai_analysis", F.when(hit, F.col("_new")).otherwise(F.col("ai_analysis")))
            .withColumn("ai_analysis_time", F.when(hit, F.lit(now).cast("timestamp"))
                        .otherwise(F.col("ai_analysis_time")))
            .drop("_new", "caption_key"))


def apply_canonical(table: DataFrame, updates: DataFrame) -> DataFrame:
    """K4: set ``ai_canonical`` from (id, ai_canonical) updates."""
    upd = updates.select("id", F.col("ai_canonical").alias("_new"))
    return (table.join(upd, "id", "left")
            .withColumn("ai_canonical", F.coalesce("_new", "ai_canonical")).drop("_new"))


def rewrite_days(spark: SparkSession, table_path: str, touched: DataFrame,
                 change: Callable[[DataFrame], DataFrame]) -> None:
    """Apply ``change`` to the partitions of the caption table named by
    ``touched`` = (platform, inserted_on) and rewrite those alone.

    The new days go into folders of their own, and all become visible at once with the
    next version of the table: a run that stops half-way leaves the old version whole.
    """
    number, folders = versions.newest(spark, table_path)
    own = CAPTION_PARTITIONS  # the folders of a version are named by them
    days = {(r.platform, r.inserted_on) for r in touched.distinct().collect()}  # partitions, not rows
    names = {f"{own[0]}={p}/{own[1]}={d or '__HIVE_DEFAULT_PARTITION__'}" for p, d in days}
    old = [f for f in folders if f.rsplit("/", 1)[0] in names]
    if not old:
        return
    checkpoint_dir(spark)
    rows = change(versions.read_folders(spark, table_path, old, CAPTION_SCHEMA)).checkpoint(eager=True)
    versions.replace(spark, table_path, number, old, rows, CAPTION_PARTITIONS)


def update_analysis(spark: SparkSession, table_path: str, updates: DataFrame, now: dt.datetime) -> None:
    """K3 on the stored caption table: only days with a matching row are rewritten."""
    table = read_version(spark, table_path, CAPTION_SCHEMA)
    keys = updates.withColumn("caption_key", key_prefix("caption")).select(*POST_KEY)
    touched = table.withColumn("caption_key", key_prefix("caption")).join(keys, POST_KEY, "left_semi")
    rewrite_days(spark, table_path, touched.select(*CAPTION_PARTITIONS),
                 lambda part: apply_analysis(part, updates, now))


def update_canonical(spark: SparkSession, table_path: str, updates: DataFrame) -> None:
    """K4 on the stored caption table: only days with an updated row are rewritten."""
    table = read_version(spark, table_path, CAPTION_SCHEMA)
    rewrite_days(spark, table_path, table.join(updates, "id", "left_semi").select(*CAPTION_PARTITIONS),
                 lambda part: apply_canonical(part, updates))


def write_lines(lines: DataFrame, path: str, order_col: str = "position") -> None:
    """K5: text lines in order, as range-partitioned sorted part files (read
    back in name order they give the full order)."""
    lines.orderBy(order_col).select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The lines that K5 wrote, as (position, line): by part file, then by place in it.

    Part files are read in splits by many tasks; a split's rows come in order."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"))
    checkpoint_dir(spark)
    return global_rank(rows.checkpoint(eager=True), ["part", "block", "row"], "position").select("position", "line")


def append_seed_urls(urls: DataFrame, seed_path: str, log_path: str, run_id: str) -> None:
    """K6: add sampled profile URLs to the seed list; overwrite the list
    of added URLs. A run has a folder of its own below the list, so a run that
    is done again replaces what it added and adds nothing twice."""
    out = urls.select(F.col("url").alias("value"))
    out.write.mode("overwrite").text(f"{seed_path}/run-{run_id}")
    out.write.mode("overwrite").text(log_path)


def snapshot_json(raw: DataFrame, root: str, size: str, now: dt.datetime) -> str:
    """K7: save the fetched records under ``size=<size>/ts=<timestamp>``."""
    path = f"{root}/size={size}/ts={now:%Y-%m-%d_%H-%M-%S}"
    raw.write.mode("errorifexists").json(path)
    return path


def latest_snapshot(spark: SparkSession, root: str, size: str) -> DataFrame:
    """The records of the newest snapshot of a size that K7 has completed; only its
    files are read."""
    done = [t for t in child_names(spark, f"{root}/size={size}") if t.startswith("ts=")
            and path_exists(spark, f"{root}/size={size}/{t}/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], "record string")
    return spark.read.schema("record string").json(f"{root}/size={size}/{max(done)}")
