"""Scraped post dumps (S1-S9) and seed lists.

Dumps are JSON files holding one top-level array. Each file is read whole
(``wholetext``) and parsed to VARIANT, which keeps the rules of the dumps'
consumers: files that are not a JSON list are skipped, elements that are
not objects are skipped, and a missing key differs from a JSON null.
Files are the unit of parallelism (one task per file split group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.analysis import is_object
from ..functions.text import py_strip
from ..operators.ordering import global_rank
from .json_lists import list_records
from .tables import path_exists


# ------------------------------------------------------------ helpers -----

def _get(v: Column, path: str, typ: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", typ)


def _has(v: Column, key: str) -> Column:
    """``key in record`` (present, even when JSON null)."""
    return F.variant_get(v, f"$.{key}", "variant").isNotNull()


def _get_or(v: Column, key: str, default) -> Column:
    """``record.get(key, default)`` for strings: missing -> default, JSON
    null -> NULL."""
    return F.when(_has(v, key), _get(v, key)).otherwise(F.lit(default))


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def read_json_records(spark: SparkSession, path: str, recursive: bool = False,
                      glob: str = "*.json", exclude: str | None = None, split: bool = False) -> DataFrame:
    """(file, pos, rec) for every object element of every JSON-list file.

    ``recursive`` walks sub-folders; ``exclude`` drops files whose path
    contains the text. Unreadable/invalid files yield nothing. With ``split`` files
    of any size are read in byte ranges (``json_lists.py``); without it a file is
    read by one task, which is faster for many small files and ends at 2 GB."""
    if split:
        return list_records(spark, path, recursive, glob, exclude)
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    raw = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return records_from_text(raw, exclude)


def json_list(c) -> Column:
    """Elements of a JSON list of any length; NULL for other texts.

    Each element is its own VARIANT: one VARIANT for the whole text could not
    hold more than 128 MiB."""
    return F.from_json(c, "array<variant>")


def records_from_text(raw: DataFrame, exclude: str | None = None) -> DataFrame:
    """(file, value) whole-file texts -> (file, pos, rec) object elements."""
    if exclude:
        raw = raw.where(~F.col("file").contains(exclude))
    return (raw.select("file", F.posexplode(json_list("value")).alias("pos", "rec"))
            .where(is_object(F.col("rec"))))


def unreadable(raw: DataFrame) -> DataFrame:
    """``file`` of the non-empty texts that are not a JSON list (reject output)."""
    return raw.where((py_strip("value") != "") & json_list("value").isNull()).select("file")


def posts_by_platform(recs: DataFrame) -> DataFrame:
    """S7 extraction over records: platform from the path, then each
    platform's extractor."""
    recs = recs.withColumn("platform", platform_of_path(F.col("file")))
    tiktok = F.col("platform") == "tiktok"
    found = F.when(tiktok, F.when(tiktok_complete(), F.array(tiktok_post()))
                   ).otherwise(instagram_posts_of())
    return explode_posts(recs, found).select(
        "influencer_name", "caption", "post_url", "post_date", "ord", "platform")


def _ord(*cols) -> Column:
    return F.struct(*cols).alias("ord")


# ------------------------------------------------------- S1 profiles ------

def instagram_profiles(records: DataFrame) -> DataFrame:
    """S1 + W2: one row per post of each profile record.

    Records without username are skipped, as are records whose
    ``latestPosts`` is present but not a list (a missing one counts as an
    empty list). A later record of the same username replaces the earlier
    list; the user keeps the position of its first record. Missing
    caption/url become '' and a missing timestamp NULL."""
    rec = F.col("rec")
    lp_present = _has(rec, "latestPosts")
    lp = F.try_variant_get(rec, "$.latestPosts", "array<variant>")
    users = (records.select("file", "pos", _get(rec, "username").alias("username"),
                            F.when(~lp_present, F.array().cast("array<variant>")).otherwise(lp).alias("posts"))
             .where(_truthy(F.col("username")) & F.col("posts").isNotNull()))
    last = users.groupBy("username").agg(
        F.max_by(F.col("posts"), F.struct("file", "pos")).alias("posts"),
        F.min(F.struct("file", "pos")).alias("first"))
    p = F.col("post")
    return (last.select("username", "first", F.posexplode("posts").alias("i", "post"))
            .where(is_object(p))
            .select("username",
                    _get_or(p, "caption", "").alias("caption"),
                    _get_or(p, "url", "").alias("url"),
                    _get(p, "timestamp").alias("timestamp"),
                    _ord(F.col("first.file"), F.col("first.pos"), "i")))


# ------------------------------------------------ S2 tagged posts ---------

def tagged_posts(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flat tagged posts (owner required; caption, url and timestamp
    keys required). Returns (posts, rejects); posts append per user in
    file order."""
    rec = F.col("rec")
    owner = _get(rec, "ownerUsername")
    base = records.where(_truthy(owner))
    complete = _has(rec, "caption") & _has(rec, "url") & _has(rec, "timestamp")
    posts = base.where(complete).select(
        owner.alias("username"), _get(rec, "caption").alias("caption"), _get(rec, "url").alias("url"),
        _get(rec, "timestamp").alias("timestamp"),
        F.try_variant_get(rec, "$.mentions", "array<string>").alias("mentions"),
        _ord("file", "pos"))
    rejects = base.where(~complete).select("file", "pos", F.to_json("rec").alias("record"))
    return posts, rejects


def merge_big_small(big: DataFrame, small: DataFrame) -> DataFrame:
    """Small-list posts appended after the big-list posts of each user."""
    b = big.withColumn("ord", F.struct(F.lit(0).alias("src"), F.col("ord").alias("o")))
    s = small.withColumn("ord", F.struct(F.lit(1).alias("src"), F.col("ord").alias("o")))
    return b.unionByName(s)


# ------------------------------------------------------ S3 tiktok ---------

def tiktok_posts(records: DataFrame) -> DataFrame:
    """S3: posts with an author name and all of text, createTimeISO and
    webVideoUrl present."""
    rec = F.col("rec")
    name = _get(rec, "authorMeta.name")
    complete = _has(rec, "text") & _has(rec, "createTimeISO") & _has(rec, "webVideoUrl")
    return records.where(_truthy(name) & complete).select(
        name.alias("username"), _get(rec, "text").alias("caption"), _get(rec, "webVideoUrl").alias("url"),
        _get(rec, "createTimeISO").alias("timestamp"), _ord("file", "pos"))


# ----------------------------------------------------- S4 hashtag ---------

def hashtag_posts(records: DataFrame) -> DataFrame:
    """S4 + O2: flat posts, newest first (ISO text order)."""
    rec = F.col("rec")
    complete = _has(rec, "caption") & _has(rec, "url") & _has(rec, "timestamp")
    return (records.where(complete)
            .select(_get(rec, "ownerUsername").alias("username"), _get(rec, "caption").alias("caption"),
                    _get(rec, "url").alias("url"), _get(rec, "timestamp").alias("timestamp"),
                    _ord("file", "pos"))
            .orderBy(F.desc("timestamp"), "ord"))


# ------------------------------------------- S5/S6 generic extractors -----

def _post(name: Column, caption: Column, url: Column, date: Column) -> Column:
    return F.struct(name.alias("influencer_name"), caption.alias("caption"), url.alias("post_url"),
                    date.alias("post_date"))


def instagram_posts_of() -> Column:
    """S5 as an array of posts of ``rec`` (NULL entries are no posts).

    Profile records with a non-empty ``latestPosts`` list give their posts
    that have a truthy url (owner = post owner or profile username); other
    records count as a post when they have a truthy url and a ``caption`` key."""
    rec = F.col("rec")
    item_user = F.when(_truthy(_get(rec, "username")), _get(rec, "username"))

    def owner(p: Column) -> Column:
        name = _get(p, "ownerUsername")
        return F.coalesce(F.when(_truthy(name), name), item_user)

    def as_post(p: Column) -> Column:
        return _post(owner(p), _get(p, "caption"), _get(p, "url"), _get(p, "timestamp"))
    latest = F.try_variant_get(rec, "$.latestPosts", "array<variant>")
    listed = F.transform(latest, lambda p: F.when(is_object(p) & _truthy(_get(p, "url")), as_post(p)))
    single = F.when(_truthy(_get(rec, "url")) & _has(rec, "caption"), F.array(as_post(rec)))
    return F.when(F.coalesce(F.size(latest) > 0, F.lit(False)), listed).otherwise(single)


def tiktok_complete() -> Column:
    rec = F.col("rec")
    return _has(rec, "text") & _has(rec, "createTimeISO") & _has(rec, "webVideoUrl")


def tiktok_post() -> Column:
    rec = F.col("rec")
    return _post(_get(rec, "authorMeta.name"), _get(rec, "text"), _get(rec, "webVideoUrl"),
                 _get(rec, "createTimeISO"))


def explode_posts(records: DataFrame, found: Column) -> DataFrame:
    """One row per post of ``found``, with ``ord``: one scan and one parse of
    the records whatever their kinds."""
    return (records.select("*", F.posexplode(found).alias("i", "p")).where(F.col("p").isNotNull())
            .select("*", "p.*", _ord("file", "pos", "i")).drop("p", "i"))


def extract_instagram(records: DataFrame) -> DataFrame:
    """Posts of profile records and single posts."""
    return explode_posts(records, instagram_posts_of()).select(
        "influencer_name", "caption", "post_url", "post_date", "ord")


def extract_tiktok(records: DataFrame) -> DataFrame:
    """Records with text, createTimeISO and webVideoUrl; the author may
    be missing (name NULL, row kept)."""
    return explode_posts(records, F.when(tiktok_complete(), F.array(tiktok_post()))).select(
        "influencer_name", "caption", "post_url", "post_date", "ord")


# ----------------------------------------------- S7/S8/S9 backfills -------

def platform_of_path(file: Column) -> Column:
    return F.when(file.contains("/tiktok/"), F.lit("tiktok")).otherwise(F.lit("instagram"))


def json_tree_posts(spark: SparkSession, root: str, exclude: str | None = None, split: bool = False) -> DataFrame:
    """Every ``*.json`` under ``root``; platform from the path; each
    platform's extractor. Output: (platform, influencer_name, caption,
    post_url, post_date, ord) with ord in sorted-file order."""
    return posts_by_platform(read_json_records(spark, root, recursive=True, exclude=exclude, split=split))


def mentions_of(recs: DataFrame, seen: Observation | None = None) -> DataFrame:
    """S8 over (file, pos, rec): flat tagged posts; rows without url are skipped.

    ``seen`` gets ``scanned`` and ``skipped_no_url``, counted in the pass that
    reads the posts (it has them once that pass has run)."""
    rec = F.col("rec")
    url = _get(rec, "url")
    if seen is not None:
        recs = recs.observe(seen, F.count(F.lit(1)).alias("scanned"),
                            F.count_if(~F.coalesce(_truthy(url), F.lit(False))).alias("skipped_no_url"))
    return recs.where(_truthy(url)).select(
        F.lit("instagram").alias("platform"), _get(rec, "ownerUsername").alias("influencer_name"),
        _get(rec, "caption").alias("caption"), url.alias("post_url"), _get(rec, "timestamp").alias("post_date"),
        _ord("file", "pos", F.lit(0).alias("i")))


def archived_mentions(spark: SparkSession, path: str, seen: Observation | None = None) -> DataFrame:
    """Flat tagged posts of archived files (see ``mentions_of``)."""
    return mentions_of(read_json_records(spark, path), seen)


def successful_runs(runs: DataFrame, max_runs: int | None = None) -> DataFrame:
    """SUCCEEDED runs with a dataset id, with ``run_rank`` (1 = newest).
    With ``max_runs`` only the newest runs count, before the status filter."""
    newest = runs if max_runs is None else runs.orderBy(F.desc("startedAt"), "run_id").limit(max_runs)
    ok = newest.where((F.col("status") == "SUCCEEDED") & _truthy(F.col("defaultDatasetId")))
    return global_rank(ok, [F.desc("startedAt"), "run_id"], "run_rank")


def run_datasets(spark: SparkSession, runs: DataFrame, dataset_root: str, platform: str) -> DataFrame:
    """Posts of the datasets of successful runs, which are files
    ``<dataset_root>/<datasetId>.json``; see ``posts_of_runs``. Spark lists the
    folder; a run without a file, or a file without a run, gives no posts."""
    if not path_exists(spark, dataset_root):
        raw = spark.createDataFrame([], "file string, value string")
    else:
        raw = (spark.read.option("pathGlobFilter", "*.json").text(dataset_root, wholetext=True)
               .select(F.col("_metadata.file_path").alias("file"), "value"))
    return posts_of_runs(raw, runs, platform)


def posts_of_runs(raw: DataFrame, runs: DataFrame, platform: str) -> DataFrame:
    """S9 over (file, value): posts of the datasets that the manifest ``runs`` names.

    The manifest is joined before any text is parsed. ``ord`` starts with the run
    rank, so the newest run's copy of a post wins the first-wins de-duplication."""
    manifest = runs.select(F.col("defaultDatasetId").alias("dataset_id"), "run_rank")
    wanted = raw.withColumn("dataset_id", F.regexp_extract("file", r"([^/]+)\.json$", 1)).join(manifest, "dataset_id")
    recs = (wanted.select(F.format_string("%09d", F.col("run_rank")).alias("file"),
                          F.posexplode(json_list("value")).alias("pos", "rec")).where(is_object(F.col("rec"))))
    posts = (extract_tiktok if platform == "tiktok" else extract_instagram)(recs)
    return posts.withColumn("platform", F.lit(platform)).withColumn("run_rank", F.col("ord.file").cast("int"))


# ------------------------------------------------ S10/S11 seed lists ------

def seed_list(spark: SparkSession, path: str) -> DataFrame:
    """Stripped, non-blank lines with their position, of a file or of all files
    below a folder (K6 adds a folder per run)."""
    from .discounts import read_lines
    return stripped_lines(read_lines(spark, path))


def stripped_lines(lines: DataFrame) -> DataFrame:
    """S10 over (file, pos, line)."""
    return (lines.select("file", "pos", py_strip("line").alias("value"))
            .where(F.col("value") != ""))


def sectioned_list(spark: SparkSession, path: str, size: str) -> DataFrame:
    """S11 + W11: names under the header ``<size>:`` (case-insensitive) up
    to the next line ending in ``:``."""
    from .discounts import read_lines
    return section_names(read_lines(spark, path), size)


def section_names(lines: DataFrame, size: str, segment_lines: int | None = None) -> DataFrame:
    """S11 over (file, pos, line): a file is scanned in segments."""
    if size not in ("small", "big"):
        raise ValueError(f"no section {size!r}: choose small or big")
    from .discounts import SEGMENT_LINES, running_last
    lines = stripped_lines(lines)
    header = F.when(F.col("value").endswith(":"), F.lower("value"))
    return (running_last(lines, header, "section", segment_lines or SEGMENT_LINES)
            .where(~F.col("value").endswith(":") & (F.col("section") == f"{size}:"))
            .select("file", "pos", F.col("value").alias("username")))
