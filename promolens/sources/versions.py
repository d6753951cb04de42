"""Tables with versions: a write is seen whole or not at all.

Data lies in ``<partitions>/v=<id>`` folders that are never changed once written. A
manifest ``_manifest/<number>`` lists the folders that make up one version and ends
with a closing line; readers follow the newest complete one. A writer puts its rows into
new folders first and then creates the next manifest, which fails if another writer was
faster. A run that stops before that leaves folders that no version names.

The driver handles names of folders only: one per partition and write.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MANIFESTS, CLOSING, VERSION = "_manifest", "end", "v"


class Outrun(RuntimeError):
    """Another writer made the next version first; nothing of this write is visible."""


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _place(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []


def newest(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """(number, folders) of the newest complete version; (-1, []) without any."""
    numbers = sorted((int(n) for n in _names(spark, f"{path}/{MANIFESTS}") if n.isdigit()), reverse=True)
    for number in numbers:
        fs, place = _place(spark, f"{path}/{MANIFESTS}/{number:012d}")
        stream = fs.open(place)
        try:
            lines = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()
        if lines and lines[-1] == CLOSING:
            return number, lines[:-1]
    return -1, []


def read_version(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest version of a table (empty without any)."""
    return read_folders(spark, path, newest(spark, path)[1], schema)


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    full = StructType([*schema.fields, StructField(VERSION, StringType())])
    return (spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])
            .drop(VERSION))


def write_folders(rows: DataFrame, path: str, partitions: list[str]) -> list[str]:
    """Write rows into new folders that no version names yet; returns the folders."""
    spark, own = rows.sparkSession, uuid.uuid4().hex
    (rows.withColumn(VERSION, F.lit(own)).write.mode("append").partitionBy(*partitions, VERSION).parquet(path))
    fs, root = _place(spark, path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{'*/' * len(partitions)}{VERSION}={own}")
    depth = len(partitions) + 1
    return sorted("/".join(f.getPath().toString().split("/")[-depth:]) for f in fs.globStatus(pattern))


def commit(spark: SparkSession, path: str, after: int, folders: list[str]) -> int:
    """Make ``folders`` the version that follows version ``after``; returns its number.

    A manifest that was not completed (its writer stopped) is passed over."""
    taken = {int(n) for n in _names(spark, f"{path}/{MANIFESTS}") if n.isdigit()}
    if newest(spark, path)[0] != after:
        raise Outrun(path)
    number = max(taken, default=-1) + 1
    fs, place = _place(spark, f"{path}/{MANIFESTS}/{number:012d}")
    try:
        out = fs.create(place, False)
    except Exception as e:  # the file is there: another writer was faster
        raise Outrun(path) from e
    try:
        out.write(bytearray("\n".join([*sorted(folders), CLOSING, ""]).encode("utf-8")))
    finally:
        out.close()
    return number


def append(rows: DataFrame, path: str, partitions: list[str]) -> int:
    """Add rows to a table as its next version."""
    spark = rows.sparkSession
    number, folders = newest(spark, path)
    return commit(spark, path, number, folders + write_folders(rows, path, partitions))


def replace(spark: SparkSession, path: str, number: int, old: list[str], rows: DataFrame, partitions: list[str]) -> int:
    """Put rows in the place of the folders ``old`` of version ``number``, as its next version."""
    kept = sorted(set(newest(spark, path)[1]) - set(old))
    return commit(spark, path, number, kept + write_folders(rows, path, partitions))
