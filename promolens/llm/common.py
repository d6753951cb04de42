"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens._shipping import register_by_value
from promolens.session import checkpoint_dir

#: Rows and bytes sent to a Python worker at once: bounds its memory when texts are long.
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20

#: Java regular expression of the white space that the text contracts name.
BLANKS = r"[\x20\x09-\x0D]"


def with_plain_names(df: DataFrame) -> DataFrame:
    """The same columns named ``c0, c1, ...``, so that no names clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name.

    Extra columns of any name, also ones that differ in case only or that hold
    dots, never clash with what an operator adds.
    """
    found = df.columns
    plain = with_plain_names(df)
    return plain.select(*[F.col(f"c{found.index(n)}").alias(n) for n in names])


#: Parquet options for rows of several megabytes: by default sizes are checked every 100 rows.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
              "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
              "parquet.block.size": str(16 << 20), "compression": "lz4_raw"}


def written(df: DataFrame, large_rows: bool = False) -> DataFrame:
    """Cut lineage: write to the shared checkpoint folder and read again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._written_at = path
    return out


def removed(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned and that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(table._written_at)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of an Arrow batch, so that long texts fit a worker.

    Also lets Spark drop a job's shuffle files when the job has ended: operators
    of several jobs pass only written tables on.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def ship(module_name: str) -> None:
    """Send a module's functions with the tasks (executors need no install)."""
    register_by_value(sys.modules[module_name])


def kept_by_worker(name: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker process keeps from task to task.

    Shipped functions come with fresh globals for every task, so it hangs on a
    module of its own. Only for what is the same whenever it is made. A worker
    outlives an operator's stages, so it keeps one object: the last asked for.
    """
    kept = kept_objects()
    if name not in kept:
        let_go()
        kept[name] = make()
    return kept[name]


def kept_objects() -> dict[str, Any]:
    home = sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker"))
    return vars(home).setdefault("kept", {})


def let_go() -> None:
    """Free what this Python worker keeps of an earlier operator, also for other processes."""
    kept = kept_objects()
    if kept:
        kept.clear()
        gc.collect()
        if sys.platform == "linux":  # what glibc has free goes back to the system
            getattr(ctypes.CDLL(None), "malloc_trim", int)(0)


def send(spark: SparkSession, thing: object | None) -> Broadcast:
    """Broadcast an object's attributes (plain data, so executors need no install)."""
    return spark.sparkContext.broadcast(None if thing is None else dict(vars(thing)))


def received(shared: Broadcast, kind: type) -> Any:
    """The object that was sent, or None."""
    if shared.value is None:
        return None
    out = kind.__new__(kind)
    out.__dict__.update(shared.value)
    return out


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


ship(__name__)
