"""Caption table scan (S12): Parquet (or any table) with the fixed column
list; filters from ``operators/filters.py`` are pushed into the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from .versions import read_version

CAPTION_SCHEMA = StructType([
    StructField("id", LongType()),
    StructField("influencer_name", StringType()),
    StructField("caption", StringType()),
    StructField("post_url", StringType()),
    StructField("post_date", TimestampType()),
    StructField("inserted_at", TimestampType()),
    StructField("ai_analysis", StringType()),
    StructField("ai_canonical", StringType()),
    StructField("ai_analysis_time", TimestampType()),
    StructField("platform", StringType()),
    # partition columns: platform and the day of inserted_at, so that an update
    # rewrites only the days it touches
    StructField("inserted_on", DateType()),
])
CAPTION_PARTITIONS = ["platform", "inserted_on"]

ARCHIVE_SCHEMA = StructType([
    StructField("influencer_name", StringType()),
    StructField("caption", StringType()),
    StructField("post_url", StringType()),
    StructField("post_date", TimestampType()),
    # caption part of the post key (F2), stored so that insert-ignore checks
    # read two narrow key columns instead of every full caption
    StructField("caption_key", StringType()),
    StructField("platform", StringType()),
])


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A partitioned Parquet table (empty when absent)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder, in whatever file system the path names?"""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds (none when it is absent)."""
    if not path_exists(spark, path):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]


def caption_table(spark: SparkSession, path: str) -> DataFrame:
    """Caption table with its fixed column list."""
    return read_version(spark, path, CAPTION_SCHEMA).select(
        *[f.name for f in CAPTION_SCHEMA.fields if f.name != "inserted_on"])


def caption_days(spark: SparkSession, path: str, first: dt.date, last: dt.date,
                 platform: str | None = None) -> DataFrame:
    """Rows of some insert days, and of one platform if given. Both are partition
    columns, so only the files of these days are read."""
    rows = read_version(spark, path, CAPTION_SCHEMA).where(F.col("inserted_on").between(F.lit(first), F.lit(last)))
    return rows if platform is None else rows.where(F.col("platform") == platform)


def jdbc_caption_table(spark: SparkSession, url: str, table: str, properties: dict) -> DataFrame:
    """S12 over JDBC (a database reachable from the executors)."""
    df = spark.read.jdbc(url, table, properties=properties)
    return df.select("id", "influencer_name", "caption", "post_url", "post_date", "inserted_at",
                     "ai_analysis", "ai_canonical", "ai_analysis_time").withColumn("platform", F.lit(table))
