"""Pipeline log scan (S16, O8): the report block of the newest log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import py_strip
from .discounts import read_lines
from .tables import child_names


def latest_file(lines: DataFrame) -> DataFrame:
    """Only the lines of the file with the greatest name."""
    newest = lines.agg(F.max("file").alias("file"))
    return lines.join(newest, "file", "left_semi")


def report_block(lines: DataFrame) -> DataFrame:
    """Per file, the lines after the first ``**PRINTING RESULTS**``
    line up to the next ``**FINISHED MAIN PIPELINE**`` line, without blank
    lines, ``**...**`` lines and the ``Printed N unique ...`` summary.
    Markers are found with per-file aggregates (no window)."""
    s = py_strip("line")
    starts = (lines.where(s == rules.PRINTING_RESULTS_MARKER)
              .groupBy("file").agg(F.min("pos").alias("_start")))
    with_start = lines.join(starts, "file")
    ends = (with_start.where((s == rules.PIPELINE_END_MARKER) & (F.col("pos") > F.col("_start")))
            .groupBy("file").agg(F.min("pos").alias("_end")))
    block = (with_start.join(ends, "file", "left")
             .where((F.col("pos") > F.col("_start"))
                    & (F.col("_end").isNull() | (F.col("pos") < F.col("_end")))))
    stripped = py_strip("line")
    keep = ((stripped != "")
            & ~(stripped.startswith("**") & stripped.endswith("**"))
            & ~stripped.rlike(rules.PRINTED_SUMMARY_PATTERN))
    return block.where(keep).select("file", "pos", "line")


def latest_log_lines(spark: SparkSession, logs_dir: str) -> DataFrame:
    """Report lines of the newest ``main_pipeline_*.log`` as (ord, line)."""
    names = [n for n in child_names(spark, logs_dir) if n.startswith("main_pipeline_") and n.endswith(".log")]
    if not names:
        return spark.createDataFrame([], "ord int, line string")
    return report_block(read_lines(spark, f"{logs_dir}/{max(names)}")).select(F.col("pos").alias("ord"), "line")
