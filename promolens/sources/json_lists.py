"""Large files of one JSON list, read in byte ranges by many tasks.

Spark's text reader cuts the files after every ``}``, in ranges, so that no task
holds a file. Whether a cut is the end of a record depends on what came before it:
inside a string or not, and how deep. Both are running sums over the pieces of
a file (quotes, brackets), taken within every range and completed by the sums of the
ranges before it (one row per range). Pieces between two such ends are put together
and parsed; a group is as long as a record and what stands between records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.analysis import is_object
from ..session import checkpoint_dir


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _brackets(text: Column) -> Column:
    """Brackets opened less those closed in a text that starts outside a string; a piece holds no ``}``."""
    outside = F.regexp_replace(text, r'"[^"]*(?:"|\z)', "")
    return _count(outside, "[{") - _count(outside, "]")


def pieces_of(spark: SparkSession, path: str, recursive: bool, glob: str, exclude: str | None) -> DataFrame:
    """``file, range, row, value`` and what each piece adds: quotes, and brackets if it
    starts outside or inside a string."""
    reader = spark.read.option("lineSep", "}").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    raw = reader.text(path).select(F.col("_metadata.file_path").alias("file"),
                                   F.col("_metadata.file_block_start").alias("range"), "value")
    if exclude:
        raw = raw.where(~F.col("file").contains(exclude))
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped signs
    after = F.regexp_replace(F.col("plain"), r'\A[^"]*(?:"|\z)', "")  # behind the string that it starts in
    checkpoint_dir(spark)
    return (raw.withColumn("row", F.monotonically_increasing_id()).withColumn("plain", plain)
            .withColumn("quotes", _count(F.col("plain"), '"'))
            .withColumn("outside", _brackets(F.col("plain"))).withColumn("inside", _brackets(after))
            .drop("plain").checkpoint(eager=True))


def running_sum(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """The sum of ``value`` in a file up to and with each piece."""
    here = Window.partitionBy("file", "range").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    valued = rows.withColumn("_v", value)
    carried = valued.groupBy("file", "range").agg(F.sum("_v").alias("_s")).select(
        "file", "range", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_carried"))
    return (valued.withColumn(name, F.sum("_v").over(here)).join(carried, ["file", "range"])
            .withColumn(name, F.col(name) + F.col("_carried")).drop("_v", "_carried").checkpoint(eager=True))


def list_records(spark: SparkSession, path: str, recursive: bool = False, glob: str = "*.json",
                 exclude: str | None = None) -> DataFrame:
    """(file, pos, rec) for every object element of every file that is a JSON list.

    The same rows as of ``posts.read_json_records``, of files of any size; a file
    that is not a JSON list as a whole gives none."""
    pieces = pieces_of(spark, path, recursive, glob, exclude)
    ends = pieces.groupBy("file").agg(F.max("row").alias("end"))
    narrow = pieces.drop("value").join(ends, "file").withColumn("tail", F.col("row") == F.col("end")).drop("end")
    state = running_sum(narrow, F.col("quotes"), "seen")
    within = F.col("seen") % 2 == 1
    started_within = (F.col("seen") - F.col("quotes")) % 2 == 1
    closes = (~within & ~F.col("tail")).cast("long")  # the sign that ends the piece
    state = running_sum(state, F.when(started_within, F.col("inside")).otherwise(F.col("outside")) - closes, "depth")
    last_of_record = ((closes == 1) & (F.col("depth") == 1)).cast("long")
    state = running_sum(state, last_of_record, "ended").withColumn("part", F.col("ended") - last_of_record)

    whole = state.where("tail").select("file", ((F.col("depth") == 0) & ~within).alias("closed"))
    text = F.concat("value", F.when(F.col("tail"), "").otherwise("}"))
    parts = (pieces.select("row", "value").join(state.select("file", "row", "part", "tail"), "row")
             .groupBy("file", "part").agg(
                 F.array_sort(F.collect_list(F.struct("row", text.alias("text")))).alias("texts"),
                 F.max("tail").alias("tail"))
             .withColumn("text", F.array_join(F.transform("texts", lambda t: t["text"]), "")).drop("texts"))
    # a part starts with the list's bracket or a comma; the last one may hold the list's end alone
    body = F.when(F.col("part") == 0, F.regexp_extract("text", r"(?s)\A\s*\[(.*)\z", 1)).otherwise(
        F.regexp_extract("text", r"(?s)\A\s*,(.*)\z", 1))
    opened = F.when(F.col("part") == 0, F.col("text").rlike(r"\A\s*\[")).otherwise(
        F.col("text").rlike(r"\A\s*,") | F.col("tail") & F.col("text").rlike(r"\A\s*\]\s*\z"))
    inner = F.when(F.col("tail"), F.regexp_replace(body, r"\]\s*\z", "")).otherwise(body)
    empty = F.trim(F.regexp_replace(inner, r"\s", "")) == ""
    lone = F.col("tail") & ((F.col("part") == 0) | ~F.col("text").rlike(r"\A\s*,"))  # nothing has to follow
    found = F.when(empty & lone, F.array().cast("array<variant>")).when(~empty, F.from_json(
        F.concat(F.lit("["), inner, F.lit("]")), "array<variant>"))
    parsed = parts.select("file", "part", opened.alias("opened"), found.alias("found")).checkpoint(eager=True)
    good = (parsed.groupBy("file").agg(F.min(F.col("opened") & F.col("found").isNotNull()).alias("ok"))
            .join(whole, "file").where("ok AND closed").select("file"))
    # one number per part: elements of the parts before it, in segments of parts
    sized = parsed.select("file", F.floor(F.col("part") / 100_000).alias("range"), F.col("part").alias("row"),
                          F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n"))
    first = running_sum(sized, F.col("n"), "upto").select(
        "file", F.col("row").alias("part"), (F.col("upto") - F.col("n")).alias("first"))
    return (parsed.join(good, "file").join(first, ["file", "part"])
            .select("file", "first", F.posexplode("found").alias("i", "rec")).where(is_object(F.col("rec")))
            .select("file", (F.col("first") + F.col("i")).cast("int").alias("pos"), "rec"))
