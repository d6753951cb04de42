"""Composite jobs (E1-E8): plain functions over DataFrames and table paths.

A ``Warehouse`` names the folders of one deployment: the caption archive and
the caption table. Nothing here schedules anything; E8 just calls the steps
in order.
"""

from __future__ import annotations

import datetime as dt
import random
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules
from .. import sinks
from ..functions.analysis import analysed
from ..functions.extract import extract_analysis_json
from ..functions.text import keyword_match
from ..operators import discovery, filters, ingest, publish, report, resolve
from ..sources import discounts as disc
from ..sources import posts as P
from ..sources.logs import latest_log_lines
from ..session import checkpoint_dir
from ..sources.tables import caption_table

Extractor = Callable[[DataFrame], DataFrame]


@dataclass
class Warehouse:
    """The folders of one deployment: the caption archive and the caption table
    (by platform and insert day). State lives in the folders alone, so later
    runs, also of other processes, go on from it."""

    archive: str
    captions_path: str

    def captions(self, spark: SparkSession) -> DataFrame:
        return caption_table(spark, self.captions_path)


def caption_ingest(spark: SparkSession, posts: DataFrame, wh: Warehouse, now: dt.datetime,
                   keywords: Iterable[str] = rules.CAPTION_KEYWORDS) -> DataFrame:
    """Archive every normalised caption (K1) and add keyword captions to
    the caption table (K2). ``posts`` = (platform, influencer_name,
    caption, post_url, post_date, ord). Returns the A4 counts."""
    # three outputs use the normalised posts: written once
    checkpoint_dir(spark)
    archive = ingest.normalise_posts(posts).select(*ingest.POST_COLUMNS).checkpoint(eager=True)
    keyword = archive.where(keyword_match("caption", keywords))
    counts = ingest.ingest_counts(archive, keywords=keywords).checkpoint(eager=True)
    sinks.insert_archive(spark, archive, wh.archive)
    sinks.insert_captions(spark, keyword, wh.captions_path, now)
    return counts


def mention_posts(spark: SparkSession, big_path: str, small_path: str, snapshot_root: str | None = None,
                  now: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """E1 for tagged posts (S2, U1, A4): big-list posts then small-list posts
    per user, stored as instagram. Returns (posts, counts) where counts has
    users/posts for big, small and merged (one row per list). With
    ``snapshot_root`` the fetched records are also saved there (K7)."""
    records = {"big": P.read_json_records(spark, big_path), "small": P.read_json_records(spark, small_path)}
    if snapshot_root:
        for size, recs in records.items():
            sinks.snapshot_json(recs.select(F.to_json("rec").alias("record")), snapshot_root, size,
                                now or dt.datetime.now())
    big, _ = P.tagged_posts(records["big"])
    small, _ = P.tagged_posts(records["small"])
    merged = P.merge_big_small(big, small)

    def stats(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.countDistinct("username").alias("users"), F.count(F.lit(1)).alias("posts")) \
            .withColumn("list", F.lit(name))

    counts = stats(big, "big").unionByName(stats(small, "small")).unionByName(stats(merged, "merged"))
    posts = merged.select(F.lit("instagram").alias("platform"), F.col("username").alias("influencer_name"),
                          "caption", F.col("url").alias("post_url"), F.col("timestamp").alias("post_date"), "ord")
    return posts, counts


def rule_extractor(rows: DataFrame) -> DataFrame:
    """X1 as an extractor: (platform, post_url, caption, ord) -> + raw."""
    return rows.withColumn("raw", extract_analysis_json("caption"))


def analysis_attach(spark: SparkSession, wh: Warehouse, inserted_on: dt.date,
                    post_date_after: dt.datetime | None, now: dt.datetime,
                    extractor: Extractor = rule_extractor) -> DataFrame:
    """Rows of one insert day without analysis (P2, P5) -> extractor
    (X1 or any DataFrame job producing ``raw`` model text) -> X2 -> J2/K3.
    Returns the updates applied."""
    table = wh.captions(spark)
    todo = filters.not_analysed(filters.records_for_date(table, inserted_on, post_date_after))
    rows = todo.select("platform", "post_url", "caption", F.struct("inserted_at", "id").alias("ord"))
    out = extractor(rows)
    updates = analysed(out.select("platform", "post_url", "caption", "ord", "raw"))
    checkpoint_dir(spark)
    updates = updates.checkpoint(eager=True)
    sinks.update_analysis(spark, wh.captions_path, updates, now)
    return updates


def canonical_attach(spark: SparkSession, wh: Warehouse, since: dt.datetime,
                     discount_lines: DataFrame, source_texts: DataFrame | None = None,
                     text_col: str = "value") -> DataFrame:
    """Webshops to resolve (A1) -> known names (A2) -> J6 -> J3/K4.
    Returns A10 (rows updated per canonical)."""
    table = wh.captions(spark)
    unknown = report.webshops_to_resolve(filters.records_since(table, since)).select(
        F.col("webshop").alias("name"))
    if source_texts is None:
        known = disc.canonical_names_from_discounts(discount_lines)
    else:
        known = disc.known_names(discount_lines, source_texts, text_col)
    mapping = resolve.resolve_names(unknown, known.select(F.col("name").alias("key")))
    checkpoint_dir(spark)
    updates = resolve.attach_canonical(filters.records_since(table, since, inclusive=True), mapping)
    updates = updates.checkpoint(eager=True)
    sinks.update_canonical(spark, wh.captions_path, updates)
    return resolve.rows_per_canonical(updates)


def discount_report(spark: SparkSession, wh: Warehouse, since: dt.datetime,
                    discount_lines: DataFrame, with_urls: bool = True) -> DataFrame:
    """E4 over the current caption table."""
    rows = filters.records_since(wh.captions(spark), since)
    return report.report_lines(rows, disc.known_discounts(discount_lines), with_urls)


def publication(lines: DataFrame, today: dt.date, seed: int | None, discount_batches: DataFrame | None,
                archive_batches: DataFrame | None, sort: bool = True,
                r: publish.PublishRules = publish.PublishRules()) -> publish.PublishResult:
    """E5 over (ord, line). ``seed=None`` draws one seed for this run (the
    run is then random, but every task and retry of it uses the same seed)."""
    if seed is None:
        seed = random.SystemRandom().randrange(1 << 31)
    training = None
    if sort and (discount_batches is not None or archive_batches is not None):
        training = disc.training_brands(discount_batches, archive_batches)
    return publish.publish(lines, today, seed, training, sort, r)


def publication_from_log(spark: SparkSession, logs_dir: str, today: dt.date, seed: int | None,
                         discount_batches: DataFrame | None, archive_batches: DataFrame | None,
                         sort: bool = True, r: publish.PublishRules = publish.PublishRules()) -> publish.PublishResult:
    """E5 on the report block of the newest pipeline log."""
    return publication(latest_log_lines(spark, logs_dir), today, seed, discount_batches, archive_batches, sort, r)


def influencer_discovery(spark: SparkSession, posts_root: str, known_names: DataFrame,
                         existing_seed_lines: int, seed: int,
                         brands: Iterable[str] = rules.DISCOVERY_BRANDS,
                         min_brands: int = rules.DISCOVERY_MIN_BRANDS,
                         max_total: int = rules.DISCOVERY_MAX_TOTAL, seed_path: str | None = None,
                         log_path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(listing, summary, sample) from tagged-post dumps under
    ``posts_root``. With ``seed_path`` and ``log_path`` the sample is added to
    the seed list and logged (K6)."""
    recs = P.read_json_records(spark, posts_root, recursive=True)
    posts = recs.select(F.try_variant_get("rec", "$.ownerUsername", "string").alias("ownerUsername"),
                        F.try_variant_get("rec", "$.mentions", "array<string>").alias("mentions"))
    users = discovery.users_with_brands(discovery.explode_mentions(posts), brands, min_brands)
    flagged = discovery.flag_known(users, known_names)
    sample = discovery.sample_new_users(flagged, max_total, existing_seed_lines, seed)
    if seed_path and log_path:
        sinks.append_seed_urls(sample, seed_path, log_path, str(seed))
    return discovery.listing(flagged), discovery.summary(flagged), sample


def backfill_json_tree(spark: SparkSession, root: str, wh: Warehouse,
                       exclude: str | None = None, split: bool = False) -> DataFrame:
    """Archive every post of a JSON dump tree (S7, F1, W1, K1); ``split`` for
    large files. Returns A8 (raw vs unique per platform)."""
    counts, _ = _archive(spark, P.json_tree_posts(spark, root, exclude, split), wh)
    return counts


def _archive(spark: SparkSession, raw: DataFrame, wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Normalise, archive (K1) and count (A8) posts; (counts, normalised posts)."""
    checkpoint_dir(spark)
    normalised = ingest.normalise_posts(raw).select(*ingest.POST_COLUMNS).checkpoint(eager=True)
    counts = ingest.raw_vs_unique(normalised).checkpoint(eager=True)
    sinks.insert_archive(spark, normalised, wh.archive)
    return counts, normalised


def backfill_runs(spark: SparkSession, runs: DataFrame, dataset_root: str, platform: str, wh: Warehouse,
                  max_runs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Archive the datasets of the successful runs (S9), newest run first.
    Returns (A8, A11)."""
    ok = P.successful_runs(runs, max_runs)
    posts = P.run_datasets(spark, ok, dataset_root, platform)
    counts, normalised = _archive(spark, posts, wh)
    return counts, new_rows_per_run(normalised, ok)


def backfill_mentions(spark: SparkSession, path: str, wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Archive the tagged posts of archived files (S8). Returns (A8, counts
    of scanned posts and of those without url)."""
    seen = Observation()
    counts, _ = _archive(spark, P.archived_mentions(spark, path, seen), wh)
    return counts, spark.createDataFrame([(seen.get["scanned"], seen.get["skipped_no_url"])],
                                         "scanned long, skipped_no_url long")


def new_rows_per_run(posts: DataFrame, runs: DataFrame) -> DataFrame:
    """Unique normalised posts first seen in each run and the running
    total, in run order; runs that add nothing have a row too. ``posts`` and
    ``runs`` as from ``sources.posts.run_datasets`` and ``successful_runs``."""
    firsts = ingest.first_per_post(ingest.normalise_posts(posts.select(*ingest.POST_COLUMNS)))
    per_run = firsts.groupBy(F.col("ord.file").cast("int").alias("run_rank")).agg(
        F.count(F.lit(1)).alias("found"))
    added = runs.select("run_rank").join(per_run, "run_rank", "left").select(
        "run_rank", F.coalesce("found", F.lit(0)).alias("added"))
    # one row per run: a list of job runs, not of posts
    w = Window.orderBy("run_rank").rowsBetween(Window.unboundedPreceding, 0)
    return added.withColumn("running_unique", F.sum("added").over(w))


def daily_run(spark: SparkSession, wh: Warehouse, sources: dict[str, DataFrame], inserted_on: dt.date,
              post_date_after: dt.datetime, cutoff: dt.datetime, discount_lines: DataFrame,
              now: dt.datetime, extractor: Extractor = rule_extractor,
              source_texts: DataFrame | None = None) -> DataFrame:
    """Ingest (instagram, mentions, tiktok) -> analysis -> canonical
    names -> report, in that order. ``sources`` maps a platform name to its
    posts DataFrame; ``source_texts`` hold further known names (S15). Returns the report lines."""
    for platform, posts in sources.items():
        target = filters.validate_platform(platform)
        caption_ingest(spark, posts.withColumn("platform", F.lit(target)), wh, now)
    analysis_attach(spark, wh, inserted_on, post_date_after, now, extractor)
    canonical_attach(spark, wh, cutoff, discount_lines, source_texts)
    return discount_report(spark, wh, cutoff, discount_lines)


__all__ = ["Warehouse", "caption_ingest", "mention_posts", "analysis_attach", "canonical_attach", "discount_report",
           "publication", "publication_from_log", "influencer_discovery", "backfill_json_tree",
           "backfill_runs", "backfill_mentions", "new_rows_per_run", "daily_run"]
