"""Registered queries: each reference behaviour run on inputs derived from
the benchmark tables (see ``plans/driver.py``). Every callable takes
(spark, sf_dir) and returns a DataFrame whose column names match the
DuckDB oracle in ``plans/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions.analysis import analysed
from ..functions.extract import extract_analysis_json
from ..session import checkpoint_dir, configure
from ..functions.text import extraction_prompt, keyword_match, normalize_caption
from ..operators import discovery, filters, ingest, publish, report, resolve
from ..operators.ordering import global_rank, rank_within_group
from ..sources import discounts as disc
from . import driver as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# ------------------------------------------------------------- E4 --------

def _report_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.records_since(D.captions(spark, sf_dir), D.REPORT_CUTOFF)


@register("e4_report_lines")
def e4_report_lines(spark, sf_dir):
    """E4 (S13, W4, F4, P3, F16, F19, W13, J1, F20, W5): unique report lines, numbered."""
    known = disc.known_discounts(D.published_lines(spark, sf_dir))
    return report.report_lines(_report_input(spark, sf_dir), known).select(
        "platform", "line", "first_inserted_at", "first_id", "first_pos", "line_no")


# ------------------------------------------------- caption-table reads ----

def _captions(spark, sf_dir):
    return D.captions(spark, sf_dir)


@register("p2_records_for_date")
def p2_records_for_date(spark, sf_dir):
    """P2 + P4: one insert day of one platform, posts after a time."""
    df = filters.records_for_date(_captions(spark, sf_dir), D.ANALYSIS_DAY, D.POST_DATE_AFTER,
                                  platform="instagram_mention")
    return df.select("id", "influencer_name", "post_url", "post_date", "inserted_at", "ai_canonical")


@register("p3_records_since")
def p3_records_since(spark, sf_dir):
    """Rows inserted strictly after the cut-off, posts after a time."""
    df = filters.records_since(_captions(spark, sf_dir), D.REPORT_CUTOFF, D.POST_DATE_AFTER)
    return df.select("id", "platform", "influencer_name", "post_url", "inserted_at",
                     F.col("ai_analysis").isNotNull().alias("has_analysis"))


@register("p5_not_analysed")
def p5_not_analysed(spark, sf_dir):
    """P5: rows of the window still without analysis, caption NULL -> ''."""
    df = filters.not_analysed(filters.records_since(_captions(spark, sf_dir), D.REPORT_CUTOFF))
    return df.select("id", "platform", "caption", "post_url")


@register("p6_with_analysis")
def p6_with_analysis(spark, sf_dir):
    """Rows with analysis and its text, numbered i of n in insert order."""
    df = filters.with_analysis(filters.records_since(_captions(spark, sf_dir), D.REPORT_CUTOFF))
    numbered = global_rank(df.select("id", "influencer_name", "inserted_at", "post_url", "post_date", "caption",
                                     "analysis_text"),
                           ["inserted_at", "id"], "item_no", total="item_total")
    return numbered.select("item_no", "item_total", "id", "influencer_name", "post_url", "post_date", "caption",
                           "analysis_text")


@register("a1_webshops_to_resolve")
def a1_webshops_to_resolve(spark, sf_dir):
    """A1: distinct webshop names of rows without canonical name."""
    return report.webshops_to_resolve(_report_input(spark, sf_dir))


@register("w3_unique_webshop_codes")
def w3_unique_webshop_codes(spark, sf_dir):
    """W3 + F21: first entry per (webshop, code) with its influencer, as CSV-style lines."""
    firsts = report.unique_webshop_codes(_report_input(spark, sf_dir))
    return report.csv_style_lines(firsts, D.TODAY).select(
        "webshop", "code", "percentage", "influencer_name", "id", "pos", "line")


@register("s13_known_discounts")
def s13_known_discounts(spark, sf_dir):
    """S13 + W4: published list parsed; first line per (canonical, code)."""
    return disc.known_discounts(D.published_lines(spark, sf_dir))


@register("s14_names_from_discounts")
def s14_names_from_discounts(spark, sf_dir):
    """S14 + F5: canonical names from the published list."""
    return disc.canonical_names_from_discounts(D.published_lines(spark, sf_dir))


@register("s15_keys_from_source")
def s15_keys_from_source(spark, sf_dir):
    """Quoted keys followed by ':' in source texts (event payloads)."""
    return disc.keys_from_source_text(D.table(spark, sf_dir, "events"), "props")


@register("a2_known_names")
def a2_known_names(spark, sf_dir):
    """A2 + U2: union of S14 and S15 names, distinct."""
    return disc.known_names(D.published_lines(spark, sf_dir), D.table(spark, sf_dir, "events"), "props")


# ------------------------------------------------------ caption ingest ----

@register("f1_normalize_captions")
def f1_normalize_captions(spark, sf_dir):
    """caption normalisation over whole documents."""
    d = D.table(spark, sf_dir, "documents")
    return d.select("doc_id", normalize_caption("text").alias("caption"))


@register("p1_keyword_filter")
def p1_keyword_filter(spark, sf_dir):
    """P1 on normalised captions (keyword list given as parameter)."""
    d = D.table(spark, sf_dir, "documents")
    return d.select("doc_id", keyword_match(normalize_caption("text"), D.INGEST_KEYWORDS).alias("matched"))


def _ingest(spark, sf_dir):
    return ingest.split_records(D.posts(spark, sf_dir), D.INGEST_KEYWORDS)


@register("w1_archive_records")
def w1_archive_records(spark, sf_dir):
    """E1 + W1, F1, F2: archive rows, first per (platform, url, caption)."""
    archive, _ = _ingest(spark, sf_dir)
    return ingest.first_per_post(archive).drop("ord")


@register("k2_keyword_records")
def k2_keyword_records(spark, sf_dir):
    """E1 + P1, F2: keyword captions, first per post key."""
    _, keyword = _ingest(spark, sf_dir)
    return ingest.first_per_post(keyword).drop("ord")


@register("a4_ingest_counts")
def a4_ingest_counts(spark, sf_dir):
    """A4: users, posts, archived unique and keyword rows per platform."""
    archive, _ = _ingest(spark, sf_dir)
    return ingest.ingest_counts(archive, keywords=D.INGEST_KEYWORDS)


@register("a8_raw_vs_unique")
def a8_raw_vs_unique(spark, sf_dir):
    """Raw vs unique post keys per platform."""
    archive, _ = _ingest(spark, sf_dir)
    return ingest.raw_vs_unique(archive)


# ------------------------------------------------- publication filter ----

def _report_as_lines(spark, sf_dir):
    known = disc.known_discounts(D.published_lines(spark, sf_dir))
    return report.report_lines(_report_input(spark, sf_dir), known).select(
        F.col("line_no").alias("ord"), "line")


def _publish(spark, sf_dir) -> publish.PublishResult:
    lines = _report_as_lines(spark, sf_dir)
    training = disc.training_brands(None, D.history_batches(spark, sf_dir))
    return publish.publish(lines, D.TODAY, D.SEED, training,
                           r=publish.PublishRules(**D.PUBLISH_RULES))


@register("e5_classify")
def e5_classify(spark, sf_dir):
    """P7, P8, P9, P10, P11, P12 (F6, F8, J7): one drop reason or 'keep' per report line."""
    classified = publish.classify(_report_as_lines(spark, sf_dir), D.TODAY,
                                  publish.PublishRules(**D.PUBLISH_RULES))
    return classified.select(F.col("ord").alias("line_no"), "reason")


@register("e5_published")
def e5_published(spark, sf_dir):
    """E5: repaired (F7, F9, F15), collapsed (W6), de-duplicated (W7),
    ordered (O3, O4, W8, W9, W10, J8, F18, F11) and cleaned (P13, F10, F12, F13,
    F14) lines; history batches via O7, P15, A6."""
    return _publish(spark, sf_dir).published.select("position", "line")


@register("a7_filter_metrics")
def a7_filter_metrics(spark, sf_dir):
    """Per-rule counters of the publication filter (P7-P11 drops, F7, F9, F15, W6, W7, F12-F14)."""
    return _publish(spark, sf_dir).metrics


@register("a6_brand_avg_positions")
def a6_brand_avg_positions(spark, sf_dir):
    """A6 (O7, P15): average first position of each brand in
    the history batches."""
    training = disc.training_brands(None, D.history_batches(spark, sf_dir))
    return publish.brand_avg_positions(training).select("brand", F.round("avg_pos", 6).alias("avg_pos"))


# ----------------------------------------------- influencer discovery ----

def _discovery(spark, sf_dir):
    """Posts = orders by customer name; mentions = brands of the order's items."""
    li = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = D.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    orders = D.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = D.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    posts = orders.join(cust, orders.o_custkey == cust.c_custkey)
    mentions = (li.join(part, li.l_partkey == part.p_partkey)
                .join(posts, li.l_orderkey == posts.o_orderkey)
                .select(F.col("c_name").alias("username"), F.col("p_brand").alias("mention")))
    users = discovery.users_with_brands(mentions, D.DISCOVERY_BRANDS, 2)
    known = posts.where(F.col("o_orderdate") >= filters.ts_literal(D.KNOWN_SINCE)).select(
        F.col("c_name").alias("name"))
    return discovery.flag_known(users, known)


@register("e6_user_brands")
def e6_user_brands(spark, sf_dir):
    """E6 (J9, U5, A3, P14, J4, O9): users with >= 2 tracked brands, brand list, known flag."""
    return discovery.listing(_discovery(spark, sf_dir))


@register("a5_discovery_summary")
def a5_discovery_summary(spark, sf_dir):
    """A5: totals of known and new users."""
    return discovery.summary(_discovery(spark, sf_dir))


@register("o6_sample_new_users")
def o6_sample_new_users(spark, sf_dir):
    """Seeded sample of new users, sized by the seed-list rule:
    existing lines = supplier rows, and room for a tenth of the customers."""
    existing = D.table(spark, sf_dir, "supplier").count()
    room = D.table(spark, sf_dir, "customer").count() // 10
    return discovery.sample_new_users(_discovery(spark, sf_dir), existing + room, existing, D.SEED)


# ------------------------------------------------ name resolution (E3) ---

def _spellings(spark, sf_dir):
    """Names to resolve: webshops of unresolved rows (A1), nation and
    supplier names and altered nation names (suffix, first letter dropped,
    one letter swapped)."""
    a1 = report.webshops_to_resolve(_report_input(spark, sf_dir)).select(F.col("webshop").alias("name"))
    nation = D.table(spark, sf_dir, "nation")
    supplier = D.table(spark, sf_dir, "supplier")
    return (a1.unionByName(nation.select(F.col("n_name").alias("name")))
            .unionByName(nation.select(F.concat("n_name", F.lit("NL")).alias("name")))
            .unionByName(nation.select(F.substr("n_name", F.lit(2)).alias("name")))
            .unionByName(nation.select(F.replace("n_name", F.lit("E"), F.lit("A")).alias("name")))
            .unionByName(supplier.select(F.col("s_name").alias("name"))))


def _keys(spark, sf_dir):
    """Known keys: A2 names plus lower-case nation and region names."""
    a2 = disc.known_names(D.published_lines(spark, sf_dir), D.table(spark, sf_dir, "events"), "props")
    return (a2.select(F.col("name").alias("key"))
            .unionByName(D.table(spark, sf_dir, "nation").select(F.lower("n_name").alias("key")))
            .unionByName(D.table(spark, sf_dir, "region").select(F.lower("r_name").alias("key"))))


@register("j6_name_resolution")
def j6_name_resolution(spark, sf_dir):
    """Each spelling -> closest known key or UNKNOWN."""
    return resolve.resolve_names(_spellings(spark, sf_dir), _keys(spark, sf_dir))


def _canonical_updates(spark, sf_dir):
    # the analysis JSON of unresolved rows is parsed once, for A1 and J3
    # (A1 takes rows strictly after the cut-off, J3 from the cut-off on)
    rows = filters.records_since(D.captions(spark, sf_dir), D.REPORT_CUTOFF, inclusive=True)
    checkpoint_dir(spark)
    entries = report.unresolved_entries(rows).checkpoint(eager=True)
    after = entries.where(F.col("inserted_at") > filters.ts_literal(D.REPORT_CUTOFF))
    a1 = report.webshops_to_resolve(None, after).select(F.col("webshop").alias("name"))
    mapping = resolve.resolve_names(a1, _keys(spark, sf_dir))
    return resolve.attach_canonical_entries(entries, mapping)


@register("j3_canonical_attach")
def j3_canonical_attach(spark, sf_dir):
    """E3 (A1, A2, J6, J3/K4): new canonical name per updated row."""
    return _canonical_updates(spark, sf_dir)


@register("a10_rows_per_canonical")
def a10_rows_per_canonical(spark, sf_dir):
    """A10: rows updated per canonical name."""
    return resolve.rows_per_canonical(_canonical_updates(spark, sf_dir))


# ------------------------------------------------------ more listings ----

@register("a9_posts_per_user")
def a9_posts_per_user(spark, sf_dir):
    """Each user's posts numbered in arrival order (long form; no
    per-user list is gathered in one task)."""
    archive, _ = _ingest(spark, sf_dir)
    return rank_within_group(archive.select("influencer_name", "post_url", "ord"), "influencer_name",
                             ["ord"], "pos_in_user")


@register("p16_keyword_scan")
def p16_keyword_scan(spark, sf_dir):
    """P16 + O2: keyword posts newest first, numbered i of n."""
    _, keyword = _ingest(spark, sf_dir)
    numbered = ingest.numbered_posts(keyword.select("influencer_name", "post_url", "post_date", "ord"))
    return numbered.select("item_no", "item_total", "influencer_name", "post_url", "ord")


@register("f23_prompts")
def f23_prompts(spark, sf_dir):
    """per-caption prompt text (normalised caption) for batch inference."""
    archive, _ = _ingest(spark, sf_dir)
    return archive.select("ord", extraction_prompt("caption").alias("prompt"))


# --------------------------------------------- analysis attach (E2) -----

@register("j2_analysis_attach")
def j2_analysis_attach(spark, sf_dir):
    """E2 (P5, X1, X2, F17, J2/K3): the rule extractor runs on the keyword
    captions; each result is set on every caption-table row with the same
    (platform, url, caption)."""
    # the table and the updates both come from the normalised posts:
    # normalise once (the NFKD step is the Python part)
    checkpoint_dir(spark)
    archive = ingest.normalise_posts(D.posts(spark, sf_dir)).checkpoint(eager=True)
    keyword = archive.where(keyword_match("caption", D.INGEST_KEYWORDS))
    table = archive.select(F.col("ord").alias("id"), "platform", "influencer_name", "caption", "post_url",
                           F.lit(None).cast("string").alias("ai_analysis"),
                           F.lit(None).cast("timestamp").alias("ai_analysis_time"))
    raw = keyword.withColumn("raw", extract_analysis_json("caption"))
    updates = analysed(raw.select("platform", "post_url", "caption", "ord", "raw"))
    updated = sinks.apply_analysis(table, updates, D.TODAY_TS)
    return updated.select("id", "ai_analysis", F.col("ai_analysis_time").isNotNull().alias("analysed"))
