"""First-wins / last-wins / random-survivor de-duplication.

All of them are aggregations (``min_by`` over a struct, which Spark plans as
sort aggregates), not keyed windows: the partial aggregate runs before the
shuffle, so a key that holds a third of all rows is reduced to one row per map
task before it moves, and no task ever has to hold a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  last: bool = False) -> DataFrame:
    """One row per ``keys``: the one with the smallest (or largest) ``order``.

    NULL keys form one group, like Python tuples with ``None``.
    ``order`` should be unique within a key for a deterministic pick.
    """
    payload = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in payload])
    by = F.struct(*_cols(order))
    pick = F.max_by(row, by) if last else F.min_by(row, by)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*")


def random_survivor(df: DataFrame, keys: Sequence[str], ord_col: str, seed: int | str) -> DataFrame:
    """One uniformly chosen row per key, repeatable for a seed and stable
    under task retries (hash of seed and ordinal, not ``rand()``)."""
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(ord_col).cast("string")))
    return first_per_key(df.withColumn("_ticket", ticket), keys, ["_ticket", ord_col]).drop("_ticket")


def unit_uniform(seed: int | str, *parts: Column) -> Column:
    """U[0,1) from md5(seed:parts): first 8 hex digits / 2^32 (same value in
    any engine with md5)."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substr(h, F.lit(1), F.lit(8)), 16, 10).cast("double") / F.lit(float(1 << 32))


def flag_first_in_group(df: DataFrame, key: str, ord_col: str, name: str) -> DataFrame:
    """``name`` is true for the first row (by ``ord_col``) of each key.

    The per-key minimum is a partial/final hash aggregate; joining it back
    is a broadcast join when the key count is small (AQE decides from the
    runtime size) and a skew-split sort-merge join otherwise.
    """
    firsts = df.groupBy(key).agg(F.min(ord_col).alias("_first_ord"))
    return (df.join(firsts, key, "left")
            .withColumn(name, F.col(ord_col) == F.col("_first_ord"))
            .drop("_first_ord"))
