"""Influencer discovery (E6): users whose posts mention tracked brands.

Mentions are handled in long form (one row per post and mentioned name);
the brand set is a parameter list (a literal IN list), so the match is a
filter, and the per-user brand set is bounded by the parameter size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import profile_url


def explode_mentions(posts: DataFrame, user_col: str = "ownerUsername",
                     mentions_col: str = "mentions") -> DataFrame:
    """(username, mention) from posts with a mentions array; posts without
    owner are skipped."""
    return (posts.where(F.col(user_col).isNotNull() & (F.col(user_col) != ""))
            .select(F.col(user_col).alias("username"), F.explode_outer(mentions_col).alias("mention")))


def users_with_brands(mentions: DataFrame, brands: Iterable[str] = rules.DISCOVERY_BRANDS,
                      min_brands: int = rules.DISCOVERY_MIN_BRANDS) -> DataFrame:
    """J9 + U5 + A3 + P14: per user the sorted set of tracked brands they
    mention; users with at least ``min_brands`` of them."""
    hits = mentions.where(F.col("mention").isin(*list(brands)))
    per_user = hits.groupBy("username").agg(F.array_sort(F.collect_set("mention")).alias("brands"))
    return per_user.where(F.size("brands") >= min_brands)


def flag_known(users: DataFrame, known_names: DataFrame, name_col: str = "name") -> DataFrame:
    """``known`` = the user name exists in the influencer table (left
    semi-style flag from a de-duplicated name list)."""
    names = known_names.select(F.col(name_col).alias("username")).distinct().withColumn("_hit", F.lit(True))
    return (users.join(names, "username", "left")
            .withColumn("known", F.coalesce("_hit", F.lit(False))).drop("_hit"))


def summary(flagged: DataFrame) -> DataFrame:
    """A5: total, known, new and percent new (0 when empty)."""
    return flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("known").alias("in_db"),
        F.count_if(~F.col("known")).alias("not_in_db"),
    ).withColumn("percent_not_in_db",
                 F.when(F.col("total") > 0, F.round(F.col("not_in_db") * 100.0 / F.col("total"), 2))
                 .otherwise(F.lit(0.0)))


def listing(flagged: DataFrame) -> DataFrame:
    """User, brand list text and known flag (sort at the sink)."""
    return flagged.select("username", F.array_join("brands", ", ").alias("brand_list"), "known")


def sample_new_users(flagged: DataFrame, max_total: int, existing_lines: int, seed: int) -> DataFrame:
    """U4 + O6 + F22: a repeatable random sample of unknown users, of size
    ``clamp(max_total - existing_lines, 0, available)``; the limit is the
    feature (a capped sample), planned as TakeOrderedAndProject."""
    new = flagged.where(~F.col("known"))
    n = max(0, max_total - existing_lines)
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("username")))
    return (new.select("username", ticket.alias("ticket"))
            .orderBy("ticket", "username").limit(n)
            .select("username", profile_url("username").alias("url")))
