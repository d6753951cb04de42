"""Caption ingest (E1) and archive backfill de-duplication.

Posts arrive as (platform, influencer_name, caption, post_url, post_date,
ord). Every caption is normalised (F1) and archived; keyword captions (P1)
also go to the per-platform caption table. The post key is (platform,
post_url, caption key F2); the first post per key (by
``ord``) wins, as with INSERT IGNORE in arrival order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import key_prefix, keyword_match, normalize_caption
from .dedup import first_per_key
from .ordering import global_rank, stored

POST_COLUMNS = ("platform", "influencer_name", "caption", "post_url", "post_date", "ord")


def normalise_posts(posts: DataFrame) -> DataFrame:
    return posts.withColumn("caption", normalize_caption("caption"))


def numbered_posts(posts: DataFrame, scan_for_discount_words: bool = False,
                   keywords: Iterable[str] = rules.CAPTION_KEYWORDS, caption_col: str = "caption",
                   date_col: str = "post_date") -> DataFrame:
    """Posts newest first, numbered ``item_no`` of ``item_total``; with
    ``scan_for_discount_words`` only keyword posts (P1) are listed."""
    df = posts.where(keyword_match(caption_col, keywords)) if scan_for_discount_words else posts
    # a range sort reads its input twice: what was made of the captions is written first
    return global_rank(stored(df), [F.desc(date_col), "ord"], "item_no", total="item_total")


def split_records(posts: DataFrame, keywords: Iterable[str] = rules.CAPTION_KEYWORDS
                  ) -> tuple[DataFrame, DataFrame]:
    """(archive records, keyword records) from raw posts."""
    archive = normalise_posts(posts).select(*POST_COLUMNS)
    keyword = archive.where(keyword_match("caption", keywords))
    return archive, keyword


def with_post_key(df: DataFrame) -> DataFrame:
    return df.withColumn("caption_key", key_prefix("caption"))


def first_per_post(records: DataFrame) -> DataFrame:
    """First record per (platform, post_url, caption key).

    An aggregate with map-side partial aggregation: re-scrapes of one post
    (the common hot key) collapse before the shuffle."""
    keyed = with_post_key(records)
    out = first_per_key(keyed, ["platform", "post_url", "caption_key"], ["ord"])
    return out.select(*POST_COLUMNS)


def ingest_counts(archive: DataFrame, keyword: DataFrame | None = None,
                  keywords: Iterable[str] = rules.CAPTION_KEYWORDS) -> DataFrame:
    """A4: per platform: distinct users, posts, unique archived posts and
    unique keyword posts.

    One pass over the normalised posts: a per-key aggregate records whether
    any post of the key is a keyword post (the keyword table de-duplicates
    among keyword posts only, so a key counts there when any of its posts
    matches). ``keyword`` is accepted for symmetry with ``split_records``."""
    flagged = with_post_key(archive).withColumn("_kw", keyword_match("caption", keywords))
    per_key = flagged.groupBy("platform", "post_url", "caption_key").agg(
        F.max("_kw").alias("_any_kw"))
    keys = per_key.groupBy("platform").agg(
        F.count(F.lit(1)).alias("archived"), F.count_if("_any_kw").alias("keyword_rows"))
    raw = archive.groupBy("platform").agg(
        F.countDistinct("influencer_name").alias("users"),
        F.count(F.lit(1)).alias("posts"))
    return (raw.join(keys, "platform", "left")
            .select("platform", "users", "posts", F.coalesce("archived", F.lit(0)).alias("archived"),
                    F.coalesce("keyword_rows", F.lit(0)).alias("keyword_rows")))


def raw_vs_unique(records: DataFrame) -> DataFrame:
    """Raw extracted posts vs distinct post keys per platform."""
    keyed = with_post_key(records)
    return keyed.groupBy("platform").agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_distinct(F.struct("post_url", "caption_key")).alias("unique_posts"))
