"""Global positions without single-task windows.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row
into one task. Here the data is range-partitioned and sorted once, written
to the shared checkpoint folder (so that partition contents are fixed even
when tasks are retried), and each row's position is its partition's offset
(a prefix sum over one count per partition) plus its index inside the
partition.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .._shipping import register_by_value
from ..session import checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition id above bit 33


def _width(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sorted(df: DataFrame, order_cols: Sequence[Column | str], num_partitions: int | None) -> DataFrame:
    """Range-partitioned and sorted, with a per-row sequence id ``_mid``."""
    return (df.repartitionByRange(_width(df, num_partitions), *order_cols)
            .sortWithinPartitions(*order_cols)
            .withColumn("_mid", F.monotonically_increasing_id()))


def sorted_table(df: DataFrame, order_cols: Sequence[Column | str],
                 num_partitions: int | None = None) -> DataFrame:
    """The sorted rows, written once to the shared checkpoint folder as Parquet:
    ids and partition contents are then fixed, also when tasks are retried, and
    a count per partition reads the id column alone."""
    return stored(_sorted(df, order_cols, num_partitions), "sorted")


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """The rows, written once to the shared checkpoint folder as Parquet."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_checkpoint(df: DataFrame, order_cols: Sequence[Column | str],
                      num_partitions: int | None = None) -> DataFrame:
    """The sorted rows as a checkpoint that keeps its partitions: a later map
    reads each sorted partition whole and in order."""
    checkpoint_dir(df.sparkSession)
    return _sorted(df, order_cols, num_partitions).checkpoint(eager=True)


def _pid() -> Column:
    return F.shiftright(F.col("_mid"), _LOCAL_BITS)


def _local() -> Column:
    return F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))


def global_rank(df: DataFrame, order_cols: Sequence[Column | str], name: str = "rank",
                num_partitions: int | None = None, total: str | None = None) -> DataFrame:
    """Add a 1-based position in the total order ``order_cols`` and, if asked
    for, the number of rows as ``total``.

    ``order_cols`` must be unique per row for a deterministic result.
    """
    s = sorted_table(df, order_cols, num_partitions).withColumn("_pid", _pid())
    # one row per range partition: bounded, so its windows need no partitioning and
    # the rows are not shuffled to meet it
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("_all"))
    ranked = s.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + _local() + F.lit(1))
    if total:
        ranked = ranked.withColumn(total, F.col("_all"))
    return ranked.drop("_pid", "_off", "_all", "_mid")


def grouped_prefix_sum(df: DataFrame, group_col: str, order_cols: Sequence[str], value_col: str,
                       name: str, num_partitions: int | None = None) -> DataFrame:
    """Running sum of ``value_col`` per ``group_col`` in ``order_cols`` order,
    for a small, fixed number of groups (each group may be huge).

    Rows are range-partitioned on (group, order). The running sum inside a
    sorted partition is a vectorised cumsum over its Arrow batches; the sums of
    the partitions before it (one row per partition and group: bounded) are
    joined to it afterwards, so the join may deal the rows as it likes.
    """
    s = sorted_checkpoint(df, [group_col, *order_cols], num_partitions).withColumn("_pid", _pid())
    schema = StructType(list(s.schema.fields) + [StructField("_run", DoubleType())])

    def run(batches):
        running: dict = {}
        for pdf in batches:
            keys = pdf[group_col].astype(object).where(pdf[group_col].notna(), None)
            out = pd.Series(0.0, index=pdf.index)
            for key, idx in pdf.groupby([pdf["_pid"], keys], dropna=False, sort=False).groups.items():
                cums = pdf.loc[idx, value_col].astype(float).cumsum() + running.get(key, 0.0)
                out.loc[idx] = cums
                running[key] = float(cums.iloc[-1])
            pdf["_run"] = out
            yield pdf

    sums = s.groupBy("_pid", group_col).agg(F.sum(value_col).alias("_s"))
    before = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("_pid").alias("_p"), F.col(group_col).alias("_g"),
                          F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_off"))
    local = s.mapInPandas(run, schema)
    return (local.join(F.broadcast(offsets), (F.col("_pid") == F.col("_p")) & F.col(group_col).eqNullSafe(F.col("_g")))
            .withColumn(name, F.col("_off") + F.col("_run"))
            .drop("_pid", "_p", "_g", "_off", "_run", "_mid"))


def rank_within_group(df: DataFrame, key: str, order_cols: Sequence[Column | str], name: str,
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position inside each ``key`` group, skew-safe: the global
    position in (key, order) minus the group's first global position. The
    per-group minimum is a partial/final hash aggregate, so a group holding a
    third of all rows is never gathered into one task."""
    ranked = global_rank(df, [key, *order_cols], "_g", num_partitions)
    firsts = ranked.groupBy(key).agg(F.min("_g").alias("_g0"))
    return (ranked.join(firsts, key, "left")
            .withColumn(name, F.col("_g") - F.col("_g0") + F.lit(1))
            .drop("_g", "_g0"))


# Functions of this module run inside Python workers: ship them by value so
# the workers need no install of this package.
register_by_value(sys.modules[__name__])
