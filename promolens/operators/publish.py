"""Publication filter (E5): classify, repair, de-duplicate and order report
lines.

The line is parsed once into columns; every rule is a column expression, so
the whole classification is one projection (one ``CASE WHEN``). The only
shuffles are: the first-MULTI-per-URL and random-survivor aggregates,
the first-line-per-brand aggregate, the brand score join, and the final
range-partitioned sort.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import (URL_PATTERN, brand_of_line, is_review_line, replace_first, split_fields, strip_emojis,
                              strip_prev_seen_dates, strip_urls)
from .dedup import first_per_key, flag_first_in_group, random_survivor, unit_uniform
from ..session import checkpoint_dir
from .ordering import global_rank, grouped_prefix_sum, stored

#: The columns that ``parse_line`` adds.
PARTS = ("q", "pre", "inner", "rest", "fields")
REASONS = ("unknown", "ignored", "short_code", "missing_code", "recent", "keep")


@dataclass(frozen=True)
class PublishRules:
    ignored_brands: tuple = rules.IGNORED_BRANDS
    min_code_length: dict | None = None
    default_values: dict | None = None
    default_value: str = rules.DEFAULT_DISCOUNT_VALUE
    boosted_brands: tuple = rules.BOOSTED_BRANDS
    boosted_base: float = rules.BOOSTED_BASE_SCORE
    percent_limit: float = rules.PERCENT_REVIEW_THRESHOLD
    euro_limit: float = rules.EURO_REVIEW_THRESHOLD
    recent_weeks: int = rules.RECENT_REPOST_WEEKS

    def min_lengths(self) -> dict:
        return rules.BRAND_MIN_CODE_LENGTH if self.min_code_length is None else self.min_code_length

    def defaults(self) -> dict:
        return rules.BRAND_DEFAULT_DISCOUNT_VALUES if self.default_values is None else self.default_values


def _map_lookup(mapping: dict, key: Column, value_type: str) -> Column:
    """Rule-table look-up as a literal map (parameter-sized)."""
    if not mapping:
        return F.lit(None).cast(value_type)
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v).cast(value_type)]
    return F.try_element_at(F.create_map(*kv), key)


def _brand_key(field: Column) -> Column:
    """``field.lstrip('_').lower()``."""
    return F.lower(F.regexp_replace(field, "^_+", ""))


def prev_seen_date(line: Column, today: dt.date) -> Column:
    """F8: ``..........MM-DD`` -> most recent such date on/before ``today``;
    NULL when absent or not a real date."""
    return date_of_marker(prev_seen_marker(line), today)


def prev_seen_marker(line: Column) -> Column:
    """The first ``..........MM-DD`` of the line ('' without one)."""
    return F.regexp_extract(line, rules.PREV_SEEN_DATE_PATTERN, 0)


def date_of_marker(marker: Column, today: dt.date) -> Column:
    """``prev_seen_date`` of a line's marker."""
    this_year, last_year = (F.concat(F.lit(f"{year:04}-"), F.right(marker, F.lit(5))).try_cast("date")
                            for year in (today.year, today.year - 1))
    return F.when(marker != "", F.when(this_year > F.lit(today), last_year).otherwise(this_year))


def classify(lines: DataFrame, today: dt.date, r: PublishRules = PublishRules()) -> DataFrame:
    """One reason per line, first matching rule wins.

    The parsed parts are columns of their own: CASE branches are evaluated
    conditionally, so an inline parse would be repeated in every branch."""
    df = with_reason(parse_line(lines), today, r)
    return df.drop(*PARTS)


def with_reason(parsed: DataFrame, today: dt.date, r: PublishRules = PublishRules()) -> DataFrame:
    """``classify`` on lines with their parts, which stay."""
    line, q, fields = F.col("line"), F.col("q"), F.col("fields")
    # only a repost's marker counts
    df = parsed.withColumn("_marker", F.when(line.startswith("..."), prev_seen_marker(line)))
    df = df.withColumn("_prev", date_of_marker(F.col("_marker"), today)).withColumn("_bk", _brand_key(F.get(fields, 0)))
    df = df.withColumn("_min", _map_lookup(r.min_lengths(), F.col("_bk"), "int"))
    brand_key, min_len, prev = F.col("_bk"), F.col("_min"), F.col("_prev")
    reason = (
        # Unknown brand
        F.when(line.contains('"UNKNOWN,'), "unknown")
        # Ignored brand (leading "_" stripped, lower-cased)
        .when(q & brand_key.isin(*r.ignored_brands) if r.ignored_brands else F.lit(False), "ignored")
        # Code shorter than the brand's minimum (J7 rule-table look-up)
        .when(q & (F.size(fields) >= 2) & min_len.isNotNull() & (F.length(F.get(fields, 1)) < min_len), "short_code")
        # P10: missing code
        .when(q & (F.size(fields) >= 2) & (F.lower(F.get(fields, 1)) == "none"), "missing_code")
        # Recent repost (F8 previous-seen date)
        .when(line.startswith("...") & prev.isNotNull()
              & (F.datediff(F.lit(today), prev) < 7 * r.recent_weeks), "recent")
        .otherwise("keep"))
    return df.withColumn("reason", reason).drop("_marker", "_prev", "_bk", "_min")


def parse_line(df: DataFrame) -> DataFrame:
    """F6 once: ``pre`` (text before the first ``"``, or the whole line),
    ``q`` (a quoted part exists), ``inner``, ``fields`` (stripped comma
    split of ``inner``) and ``rest`` (text after the closing quote).

    Later rules change these columns and the line is rendered from them, so
    no rule re-parses a rewritten line (that would nest every earlier rewrite
    into each later expression)."""
    line = F.col("line")
    df = df.withColumn("_pre", F.substring_index(line, '"', 1))
    df = df.withColumn("_after", F.substr(line, F.length("_pre") + F.lit(2)))  # behind the first quote
    df = (df.withColumn("q", F.col("_after").contains('"'))
          .withColumn("pre", F.when(F.col("q"), F.col("_pre")).otherwise(line))
          .withColumn("inner", F.when(F.col("q"), F.substring_index("_after", '"', 1))))
    return (df.withColumn("rest", F.when(F.col("q"), F.substr("_after", F.length("inner") + F.lit(2))))
            .withColumn("fields", F.when(F.col("q"), split_fields("inner"))).drop("_pre", "_after"))


def render() -> Column:
    """Line text from the parsed parts."""
    return F.when(F.col("q"), F.concat(F.col("pre"), F.lit('"'), F.col("inner"), F.lit('"'), F.col("rest"))
                  ).otherwise(F.col("pre"))


def repair(kept: DataFrame, r: PublishRules = PublishRules()) -> DataFrame:
    """F15, F9, F7 on kept lines; adds flags stripped/cleaned/defaulted/marked."""
    return repair_parts(parse_line(kept), r)


def repair_parts(df: DataFrame, r: PublishRules = PublishRules()) -> DataFrame:
    """``repair`` on lines with their parts."""
    pre, fields, q = F.col("pre"), F.col("fields"), F.col("q")
    # leading "..." (the line starts with pre)
    df = (df.withColumn("stripped", pre.startswith("..."))
          .withColumn("pre", F.when(F.col("stripped"), F.substr(pre, F.lit(4))).otherwise(pre)))
    # new-company brand clean (not for MULTI lines)
    has_multi = (pre.contains(rules.MULTI_TAG) | F.coalesce(F.col("inner").contains(rules.MULTI_TAG), F.lit(False))
                 | F.coalesce(F.col("rest").contains(rules.MULTI_TAG), F.lit(False)))
    df = df.withColumn("cleaned", F.coalesce(~has_multi & q & F.get(fields, 0).startswith("___"), F.lit(False)))
    cleaned = F.regexp_replace(F.lower(F.substr(F.get(fields, 0), F.lit(4))), "[^a-z0-9._]", "")
    df = df.withColumn("fields", F.when(F.col("cleaned"), F.concat(
        F.array(cleaned), F.slice(fields, F.lit(2), F.size(fields)))).otherwise(fields))
    # discount value of the (cleaned) fields
    value = F.get(fields, 2)
    df = (df.withColumn("_has3", F.coalesce(q & (F.size(fields) >= 3), F.lit(False)))
          .withColumn("_none", F.col("_has3") & (F.lower(value) == "none")))
    ok = value.rlike(rules.DISCOUNT_VALUE_PATTERN)
    num = F.regexp_extract(value, rules.DISCOUNT_VALUE_PATTERN, 1).cast("double")
    too_high = F.when(value.startswith("€"), num > F.lit(float(r.euro_limit))).otherwise(
        num > F.lit(float(r.percent_limit)))
    default = F.coalesce(_map_lookup(r.defaults(), _brand_key(F.get(fields, 0)), "string"), F.lit(r.default_value))
    df = (df.withColumn("defaulted", F.col("_none"))
          .withColumn("marked", F.coalesce(F.col("_has3") & ~F.col("_none") & (~ok | too_high), F.lit(False)))
          .withColumn("fields", F.when(F.col("_none"), F.concat(
              F.slice(fields, 1, 2), F.array(default), F.slice(fields, F.lit(4), F.size(fields)))).otherwise(fields)))
    # the quoted part is re-joined with ", " whenever a rule rewrote it
    df = df.withColumn("inner", F.when(F.col("cleaned") | F.col("_has3"), F.array_join(fields, ", "))
                       .otherwise(F.col("inner")))
    df = df.withColumn("pre", F.when(F.col("marked") & ~pre.startswith(rules.REVIEW_PREFIX),
                                     F.concat(F.lit(rules.REVIEW_HIGH), pre)).otherwise(pre))
    return df.drop("_has3", "_none").withColumn("line", render())


def collapse_multi(repaired: DataFrame) -> DataFrame:
    """Among MULTI lines with a URL keep the first per URL; drop the tag.

    One aggregate: competing lines group by URL, every other line is
    its own group (keyed by its ordinal), so no line is filtered out and
    re-unioned. ``min_by`` pre-reduces a URL shared by a third of all lines
    per map task. The line is rendered from its parts, so they alone travel."""
    return collapse_by_url(repaired.withColumn("url", multi_url()))


def multi_url() -> Column:
    """The first URL of a MULTI line ('' without one); NULL for other lines."""
    return F.when(F.col("line").contains(rules.MULTI_TAG), F.regexp_extract("line", URL_PATTERN, 0))


def collapse_by_url(repaired: DataFrame) -> DataFrame:
    """``collapse_multi`` on lines with their ``url`` from ``multi_url``."""
    df = repaired.withColumn("is_multi", F.col("line").contains(rules.MULTI_TAG))
    compete = F.coalesce(F.col("url") != "", F.lit(False))
    df = (df.withColumn("_g_url", F.when(compete, F.col("url")))
          .withColumn("_g_ord", F.when(~compete, F.col("ord"))).drop("url", "line"))
    kept = first_per_key(df, ["_g_url", "_g_ord"], ["ord"]).drop("_g_url", "_g_ord")
    # remove the first "MULTI__" of the line: in pre, else inner, else rest
    in_pre = F.col("pre").contains(rules.MULTI_TAG)
    in_inner = ~in_pre & F.coalesce(F.col("inner").contains(rules.MULTI_TAG), F.lit(False))
    kept = (kept.withColumn("_where", F.when(~F.col("is_multi"), 0).when(in_pre, 1).when(in_inner, 2).otherwise(3))
            .withColumn("pre", F.when(F.col("_where") == 1, replace_first("pre", rules.MULTI_TAG)).otherwise(F.col("pre")))
            .withColumn("inner", F.when(F.col("_where") == 2, replace_first("inner", rules.MULTI_TAG))
                        .otherwise(F.col("inner")))
            .withColumn("rest", F.when(F.col("_where") == 3, replace_first("rest", rules.MULTI_TAG))
                        .otherwise(F.col("rest")))
            .drop("_where")
            .withColumn("line", render()))
    return kept


def dedup_brand_code(kept: DataFrame, seed: int) -> DataFrame:
    """One random survivor per lower-cased (brand, code); lines without
    a quoted part or with fewer than two fields are always kept (each is its
    own group, keyed by ordinal)."""
    f = F.col("_f")
    df = (kept.withColumn("_f", F.when(F.col("q"), split_fields("inner")))
          .withColumn("_k", F.coalesce(F.col("q") & (F.size("_f") >= 2), F.lit(False))))
    df = (df.withColumn("_g_bc", F.when(F.col("_k"), F.struct(F.lower(F.get(f, 0)).alias("b"), F.lower(F.get(f, 1)).alias("c"))))
          .withColumn("_g_ord", F.when(~F.col("_k"), F.col("ord"))).drop("_k", "_f"))
    return random_survivor(df, ["_g_bc", "_g_ord"], "ord", seed).drop("_g_bc", "_g_ord")


def brand_avg_positions(training: DataFrame) -> DataFrame:
    """Per brand, the average over batches of the index of its first
    line in the batch. ``training`` = (source, file, batch_no, pos, brand).

    The index inside a batch is a window over one batch (a batch is one
    published day: bounded)."""
    from pyspark.sql import Window
    w = Window.partitionBy("source", "file", "batch_no").orderBy("pos")
    idx = training.withColumn("_idx", F.row_number().over(w) - 1)
    first = idx.groupBy("source", "file", "batch_no", "brand").agg(F.min("_idx").alias("_first"))
    return first.groupBy("brand").agg(F.avg("_first").alias("avg_pos"))


def exp_draw(seed: int, tag: str, c: Column) -> Column:
    """Exp(1) draw from the seeded hash: -ln((n+1)/2^32)."""
    return -F.ln(unit_uniform(seed, F.lit(tag), c) + F.lit(1.0 / (1 << 32)))


def publication_order(lines: DataFrame, training: DataFrame | None, seed: int,
                      r: PublishRules = PublishRules()) -> DataFrame:
    """O4 (W8, J8, F18, W9, W10): first half of scored primary lines by
    score, then the second half fairly merged with duplicate-brand lines,
    then lines of new companies. Adds ``position``."""
    df = lines.withColumn("brand", brand_of_line("line"))
    nonempty = flag_first_in_group(df.where(F.col("brand") != ""), "brand", "ord", "primary")
    df = nonempty.unionByName(df.where(F.col("brand") == "").withColumn("primary", F.lit(True)))
    score = F.lit(None).cast("double")
    if training is not None:
        avg = brand_avg_positions(training)
        df = df.join(avg, "brand", "left")
        score = F.col("avg_pos")
    if r.boosted_brands:
        boost = F.lit(float(r.boosted_base)) + unit_uniform(seed, F.lit("boost"), F.col("brand"))
        score = F.when(F.col("brand").isin(*r.boosted_brands), boost).otherwise(score)
    # used three times below (sorted, duplicate and new-company lines): the
    # scored lines are written once instead of re-running the score join
    checkpoint_dir(df.sparkSession)
    df = df.withColumn("score", score).checkpoint(eager=True)
    sortable_cond = F.col("primary") & (F.col("brand") != "") & F.col("score").isNotNull()
    # O3: stable sort by score (ties keep input order)
    sortable = global_rank(df.where(sortable_cond), ["score", "ord"], "_r", total="_n")
    early = F.col("_r") <= F.floor(F.col("_n") / 2)
    first_half = sortable.where(early).select(
        "ord", "line", F.lit(0).alias("_sec"), F.col("_r").cast("double").alias("_key"))
    to_mix = (sortable.where(~early).select("ord", "line", F.lit(0).alias("_list"),
                                                       F.col("_r").cast("double").alias("_lpos"))
              .unionByName(df.where(~F.col("primary")).select(
                  "ord", "line", F.lit(1).alias("_list"), F.col("ord").cast("double").alias("_lpos"))))
    to_mix = to_mix.withColumn("_gap", exp_draw(seed, "merge", F.col("ord")))
    mixed = grouped_prefix_sum(to_mix, "_list", ["_lpos"], "_gap", "_arrival")
    mixed = mixed.select("ord", "line", F.lit(1).alias("_sec"), F.col("_arrival").alias("_key"))
    new = df.where(~sortable_cond & F.col("primary")).select(
        "ord", "line", F.lit(2).alias("_sec"), F.col("ord").cast("double").alias("_key"))
    final = first_half.unionByName(mixed).unionByName(new)
    return global_rank(final, ["_sec", "_key", "ord"], "position").drop("_sec", "_key")


def finish(lines: DataFrame) -> DataFrame:
    """F12, F14, F13 with change flags."""
    review = is_review_line(F.col("line"))
    l1 = F.when(review, F.col("line")).otherwise(strip_urls("line"))
    df = lines.withColumn("url_stripped", l1 != F.col("line")).withColumn("line", l1)
    l2 = strip_prev_seen_dates("line")
    df = df.withColumn("date_stripped", l2 != F.col("line")).withColumn("line", l2)
    l3 = strip_emojis("line")
    return df.withColumn("emoji_stripped", l3 != F.col("line")).withColumn("line", l3)


@dataclass
class PublishResult:
    """The three outputs; sorting and counting happen only when asked for."""

    classified: DataFrame
    publish_lines: Callable[[], DataFrame]
    count_lines: Callable[[], DataFrame]

    @cached_property
    def published(self) -> DataFrame:
        return self.publish_lines()

    @cached_property
    def metrics(self) -> DataFrame:
        return self.count_lines()


def settle(lines: DataFrame, today: dt.date, r: PublishRules = PublishRules()) -> DataFrame:
    """Every line as ``given``, its ``reason`` and, of kept ones, the repaired
    parts, the flags of the repairs and, of MULTI lines, the ``url`` they compete for.

    Written once to the shared checkpoint folder as Parquet: the next steps and every
    counter read the columns they need, and the choice of kept lines reads the stored
    reason (a filter on the classification itself is pushed below it, where each
    branch would parse the line anew). A dropped line has no parts to repair."""
    classified = with_reason(parse_line(lines.select("ord", "line")), today, r)
    keep = F.col("reason") == "keep"
    repaired = repair_parts(classified.select("ord", F.col("line").alias("given"), "reason",
                                              *[F.when(keep, F.col(c)).alias(c) for c in PARTS]), r)
    return stored(repaired.withColumn("url", multi_url()).drop("fields", "line"))


def publish(lines: DataFrame, today: dt.date, seed: int, training: DataFrame | None = None,
            sort: bool = True, r: PublishRules = PublishRules()) -> PublishResult:
    """E5 over (ord, line). ``ord`` must be unique and give input order."""
    settled = settle(lines, today, r)
    repaired = settled.where(F.col("reason") == "keep")
    parts = repaired.select("ord", "q", "pre", "inner", "rest", "url").withColumn("line", render())
    # used by the random pick and by the counters: written once
    kept = stored(collapse_by_url(parts).select("ord", "line", "q", "inner", "is_multi"))
    # materialised once: the random pick is then fixed for the sort and for
    # every counter (lineage cut in the shared checkpoint folder)
    survivors = stored(dedup_brand_code(kept.drop("is_multi"), seed).select("ord", "line"))
    classified = settled.select("ord", F.col("given").alias("line"), "reason")

    def publish_lines() -> DataFrame:
        lines = survivors.select("ord", "line")
        ordered = publication_order(lines, training, seed, r) if sort else global_rank(lines, ["ord"], "position")
        return finish(ordered).select("position", "line", "url_stripped", "date_stripped", "emoji_stripped")
    return PublishResult(classified, publish_lines,
                         lambda: _metrics(classified, repaired, kept, survivors, training))


def _stack(one_row: DataFrame) -> DataFrame:
    """A one-row aggregate -> (metric, value) rows."""
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value"))
        for c in one_row.columns])).alias("m")).select("m.*")


def _metrics(classified, repaired, kept, survivors, training) -> DataFrame:
    """One (metric, value) row per counter, also for counters of 0.

    What the last cleaning changes does not depend on the order, so it is
    counted on the survivors.

    Each stage is aggregated once (all its counters in one pass); counters
    that combine two stages are emitted as signed parts and summed per
    metric, so nothing is joined and nothing is collected."""
    has_url = F.col("line").rlike(URL_PATTERN)
    by_reason = _stack(classified.agg(
        F.count(F.lit(1)).alias("input_lines"),
        *[F.count_if(F.col("reason") == reason).alias(f"dropped_{reason}") for reason in REASONS[:-1]]))
    if training is not None:
        by_reason = by_reason.unionByName(_stack(
            training.select("source", "file", "batch_no").distinct().agg(F.count(F.lit(1)).alias("training_batches"))))
    rep = _stack(repaired.agg(
        F.count_if("stripped").alias("stripped_old_repost"),
        F.count_if("cleaned").alias("cleaned_new_company"),
        F.count_if("defaulted").alias("defaulted_discount"),
        F.count_if("marked").alias("marked_high"),
        # competing MULTI lines (+) ...
        F.count_if(F.col("url") != "").alias("dropped_multi_dup")))
    kep = _stack(kept.agg(
        F.count_if("is_multi").alias("multi_groups_kept"),
        # ... minus the kept MULTI lines with a URL
        (-F.count_if(F.col("is_multi") & has_url)).alias("dropped_multi_dup"),
        # kept lines (+) minus survivors (-)
        F.count(F.lit(1)).alias("record_dups_dropped")))
    surv = _stack(survivors.agg((-F.count(F.lit(1))).alias("record_dups_dropped")))
    pub = _stack(finish(survivors.select("line")).agg(F.count_if("url_stripped").alias("urls_stripped"),
                               F.count_if("date_stripped").alias("prev_dates_stripped"),
                               F.count_if("emoji_stripped").alias("emojis_stripped"),
                               F.count(F.lit(1)).alias("output_lines")))
    parts = rep.unionByName(kep).unionByName(surv).unionByName(pub)
    summed = parts.groupBy("metric").agg(F.sum("value").cast("long").alias("value"))
    return by_reason.unionByName(summed)
