"""Published-discount list and name sources.

Inputs are DataFrames of text lines ``(ord, line)`` so the same functions
work on a JSON array file, a text file or lines Spark derives from tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import clean_name_cut, clean_name_remove_parens, company_of_record, py_strip
from ..operators.dedup import first_per_key
from ..session import checkpoint_dir


def read_json_string_array(spark: SparkSession, path: str) -> DataFrame:
    """A JSON file holding one array; one row per element ``(ord, line)``.

    Non-string elements get ``line`` NULL (they are skipped downstream).
    Files that are not a JSON array give no rows.
    """
    raw = (spark.read.text(path, wholetext=True)
           .select(F.col("_metadata.file_path").alias("file"), "value"))
    arr = F.from_json("value", "array<variant>")
    return (raw.select("file", F.posexplode(arr).alias("pos", "v"))
            .select(F.struct("file", "pos").alias("ord"),
                    F.when(F.schema_of_variant("v") == "STRING",
                           F.variant_get("v", "$", "string")).alias("line")))


def known_discounts(lines: DataFrame) -> DataFrame:
    """S13 + W4: ``name (note), code, ..., date`` -> (canonical_key, code_key,
    seen_md); lines with fewer than 3 fields are skipped; the first line per
    lower-cased (canonical, code) wins."""
    parts = F.transform(F.split("line", ",", -1), lambda x: py_strip(x))
    parsed = (lines.where(F.col("line").isNotNull())
              .select("ord", parts.alias("p"))
              .where(F.size("p") >= 3)
              .select("ord",
                      F.lower(clean_name_cut(F.get(F.col("p"), 0))).alias("canonical_key"),
                      F.lower(F.get(F.col("p"), 1)).alias("code_key"),
                      F.element_at("p", -1).alias("seen_md")))
    return first_per_key(parsed, ["canonical_key", "code_key"], ["ord"]).drop("ord")


def canonical_names_from_discounts(lines: DataFrame) -> DataFrame:
    """Text before the first comma with every ``(...)`` removed."""
    name = clean_name_remove_parens(py_strip(F.substring_index("line", ",", 1)))
    return (lines.where(F.col("line").isNotNull() & (F.col("line") != ""))
            .select(name.alias("name")).where(F.col("name") != "").distinct())


def keys_from_source_text(texts: DataFrame, text_col: str = "value") -> DataFrame:
    """Every quoted key followed by a colon, distinct."""
    return (texts.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(rules.SOURCE_KEY_PATTERN), 1))
                         .alias("name"))
            .distinct())


def known_names(discount_lines: DataFrame, source_texts: DataFrame, text_col: str = "value") -> DataFrame:
    """A2 + U2: union of S14 and S15, distinct (sort at the sink: O5)."""
    return (canonical_names_from_discounts(discount_lines)
            .union(keys_from_source_text(source_texts, text_col)).distinct())


def sorted_names(names: DataFrame, col: str = "name") -> DataFrame:
    """Names in sorted order (a range-partitioned sort)."""
    return names.orderBy(col)


# Lines end where Python's str.splitlines() ends them.
#: Those of them at which Spark's text reader does not break.
INNER_BREAK = "[\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
#: Lines of a segment: what one task scans of a file at most.
SEGMENT_LINES = 100_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files, also those below a folder, as ``(file, pos, line)`` with the position inside the file.

    A file is read in byte ranges by as many tasks as it has splits. Each range counts its
    lines; a line's position is its place in the range plus the lines of the ranges before it
    (one row per range).
    """
    raw = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.explode(F.split("value", INNER_BREAK)).alias("line"))
    checkpoint_dir(spark)
    rows = raw.withColumn("row", F.monotonically_increasing_id()).checkpoint(eager=True)
    ranges = rows.groupBy("file", "range").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("file", "range", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return rows.join(offsets, ["file", "range"]).select(
        "file", (F.col("offset") + F.col("row") - F.col("first")).alias("pos"), "line")


def segmented(lines: DataFrame, segment_lines: int) -> DataFrame:
    """The lines with the segment ``_seg`` of their file that they fall into."""
    return lines.withColumn("_seg", F.floor(F.col("pos") / segment_lines))


def running_last(lines: DataFrame, value: Column, name: str, segment_lines: int = SEGMENT_LINES) -> DataFrame:
    """The last non-null ``value`` of a file up to each line.

    A scan in two steps: every segment is scanned by itself, and what the segments
    before it hand over (one row per segment) is filled in.
    """
    rows = segmented(lines, segment_lines).withColumn("_v", value)
    here = Window.partitionBy("file", "_seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("file", "_seg").agg(
        F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("pos"))).alias("_last"))
    carried = sums.select("file", "_seg", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    return (rows.withColumn(name, F.last("_v", ignorenulls=True).over(here)).join(carried, ["file", "_seg"])
            .withColumn(name, F.coalesce(name, "_carried")).drop("_seg", "_v", "_carried"))


def batches_from_lines(lines: DataFrame, bracket_rules: bool = False,
                       segment_lines: int = SEGMENT_LINES) -> DataFrame:
    """S17/S18 + W12: blank-line separated batches as (file, batch_no, pos,
    line). With ``bracket_rules`` (a JSON array file), lines up to the first with
    ``[`` and all with ``[`` are skipped, and lines containing ``]`` close the batch.

    A batch starts at a line that follows a break. Every segment of a file counts the
    starts behind its first line; whether the first one is a start, and how many starts came
    before, goes by the segments before it (one row per segment).
    """
    stripped = py_strip("line")
    if bracket_rules:
        opened = lines.where(F.col("line").contains("[")).groupBy("file").agg(F.min("pos").alias("_open"))
        # a line holding "[" is skipped without closing the batch
        df = lines.join(opened, "file").where((F.col("pos") > F.col("_open")) & ~F.col("line").contains("[")).drop("_open")
        is_break = (stripped == "") | F.col("line").contains("]")
    else:
        df, is_break = lines, stripped == ""
    here = Window.partitionBy("file", "_seg").orderBy("pos")
    rows = segmented(df, segment_lines).withColumn("_brk", is_break).withColumn("_prev", F.lag("_brk").over(here))
    start = ~F.col("_brk") & F.coalesce("_prev", F.lit(False))
    rows = rows.withColumn("_starts", F.sum(start.cast("long")).over(
        here.rowsBetween(Window.unboundedPreceding, 0)))
    sums = rows.groupBy("file", "_seg").agg(
        F.min_by("_brk", "pos").alias("_first_brk"), F.max_by("_brk", "pos").alias("_last_brk"),
        F.max("_starts").alias("_inner"))
    by_file = Window.partitionBy("file").orderBy("_seg")
    opens = (~F.col("_first_brk") & F.coalesce(F.lag("_last_brk").over(by_file), F.lit(True))).cast("long")
    sums = sums.withColumn("_opens", opens).withColumn("_before", F.coalesce(F.sum(
        F.col("_opens") + F.col("_inner")).over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (rows.where(~F.col("_brk")).join(sums.select("file", "_seg", "_opens", "_before"), ["file", "_seg"])
            .select("file", (F.col("_before") + F.col("_opens") + F.col("_starts") - 1).cast("int").alias("batch_no"),
                    "pos", stripped.alias("line")))


def training_brands(discount_batches: DataFrame | None, archive_batches: DataFrame | None,
                    archive_limit: int | None = rules.ARCHIVE_BATCH_LIMIT,
                    min_size: int = rules.MIN_TRAINING_BATCH_SIZE) -> DataFrame:
    """O7 + P15 + U3: (source, batch_no, pos, brand) of the history batches:
    the published list without its newest batch, plus the archive batches
    (the first ``archive_limit`` if given), keeping batches of ``min_size`` or
    more lines. Brand = F3 of the line."""
    parts = []
    if discount_batches is not None:
        parts.append(discount_batches.where(F.col("batch_no") >= 1).withColumn("source", F.lit(0)))
    if archive_batches is not None:
        some = archive_batches if archive_limit is None else archive_batches.where(F.col("batch_no") < archive_limit)
        parts.append(some.withColumn("source", F.lit(1)))
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    df = df.select("source", "file", "batch_no", "pos", company_of_record("line").alias("brand"))
    if min_size <= 1:
        return df
    sizes = df.groupBy("source", "file", "batch_no").agg(F.count(F.lit(1)).alias("_n"))
    return (df.join(sizes.where(F.col("_n") >= min_size), ["source", "file", "batch_no"], "left_semi"))
