"""Registered queries for sources, look-ups and ingest steps that need texts
of their own: dump files, list files, logs and captions with codes, each
derived from the benchmark tables by a rule that ``oracle_sources.py``
follows in SQL.

A conversation stands for a file and its turns for the file's records or
lines; a file is bounded by its conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import sinks
from ..functions.extract import extract_analysis_json
from ..functions.text import key_prefix, keyword_match
from ..operators import filters, ingest, report
from ..operators.ordering import global_rank
from ..session import configure
from ..sources import discounts as disc
from ..sources import logs
from ..sources import posts as P
from . import driver as D
from . import jobs
from .queries import QUERIES, _canonical_updates


def register(fn):
    def run(spark, sf_dir):
        configure(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# ------------------------------------------------------------ dump files --

def _json(**fields: Column) -> Column:
    """JSON object text with nulls kept."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"})


def record_json() -> Column:
    """A turn as a dump record; its kind goes by the turn and the conversation."""
    conv, turn = F.col("conv_id"), F.col("turn")
    c, t = conv.cast("string"), turn.cast("string")
    stamp = F.concat(F.lit("2025-01-"), F.lpad((conv % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:0"),
                     (turn % 10).cast("string"))
    url = F.concat(F.lit("https://p/"), c, F.lit("/"), t)
    user = F.concat(F.lit("u"), (conv % 50).cast("string"))
    profile = F.concat(F.lit('{"username":"'), user, F.lit('","latestPosts":['),
                       _json(ownerUsername=F.concat(F.lit("o"), t), caption=F.col("text"), url=url, timestamp=stamp),
                       F.lit(',{"caption":"no url","url":""},7]}'))
    single = _json(username=user, ownerUsername=F.lit(None).cast("string"), caption=F.col("text"), url=url,
                   timestamp=stamp)
    tiktok = F.concat(F.lit('{"authorMeta":{"name":"'), user, F.lit('"},"text":'),
                      F.to_json(F.array("text")).substr(F.lit(2), F.length(F.to_json(F.array("text"))) - 2),
                      F.lit(',"webVideoUrl":"'), url, F.lit('","createTimeISO":"'), stamp, F.lit('"}'))
    tagged = _json(ownerUsername=user, caption=F.col("text"), url=url, timestamp=stamp,
                   mentions=F.array(F.col("role")))
    return (F.when(turn % 5 == 0, profile).when(turn % 5 == 1, single).when(turn % 5 == 2, tiktok)
            .when(turn % 5 == 3, tagged).otherwise(F.lit('"no record"')))


def dump_files(spark, sf_dir) -> DataFrame:
    """(file, value): one JSON list per conversation; some are not JSON."""
    c = D.table(spark, sf_dir, "conversations").select("conv_id", "turn", record_json().alias("r"))
    files = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "r"))).alias("rs"))
    folder = F.when(F.col("conv_id") % 3 == 0, "/dump/tiktok/").otherwise("/dump/instagram/")
    body = F.concat(F.lit("["), F.array_join(F.transform("rs", lambda x: x["r"]), ","), F.lit("]"))
    return files.select(F.concat(folder, F.lpad(F.col("conv_id").cast("string"), 12, "0")).alias("file"),
                        F.when(F.col("conv_id") % 11 == 5, F.lit("{broken")).otherwise(body).alias("value"))


def _records(spark, sf_dir) -> DataFrame:
    return P.records_from_text(dump_files(spark, sf_dir))


@register
def s7_tree_posts(spark, sf_dir):
    """S7 (S5, S6): posts of a dump tree; the platform goes by the path."""
    return P.posts_by_platform(_records(spark, sf_dir)).select(
        "platform", "influencer_name", "caption", "post_url", "post_date", F.col("ord.pos").alias("pos"),
        F.col("ord.i").alias("i"))


@register
def s7_unreadable(spark, sf_dir):
    """Dump files that are not a JSON list."""
    return P.unreadable(dump_files(spark, sf_dir))


@register
def s1_profile_posts(spark, sf_dir):
    """S1 + W2: posts of the last record of every profile."""
    return P.instagram_profiles(_records(spark, sf_dir)).select("username", "caption", "url", "timestamp")


@register
def s2_merged_mentions(spark, sf_dir):
    """S2 + U1: tagged posts of two lists, the small list's after the big list's."""
    posts, _ = P.tagged_posts(_records(spark, sf_dir))
    even = F.col("ord.file").substr(-1, 1).cast("int") % 2 == 0
    merged = P.merge_big_small(posts.where(even), posts.where(~even))
    return merged.select("username", "caption", "url", "timestamp", F.array_join("mentions", ",").alias("mentions"),
                         F.col("ord.src").alias("src"), F.col("ord.o.file").alias("file"))


@register
def s3_tiktok_posts(spark, sf_dir):
    """S3: video posts with an author."""
    return P.tiktok_posts(_records(spark, sf_dir)).select("username", "caption", "url", "timestamp")


@register
def s4_hashtag_posts(spark, sf_dir):
    """Flat posts with caption, url and time."""
    return P.hashtag_posts(_records(spark, sf_dir)).select("username", "caption", "url", "timestamp")


# ------------------------------------------------------ list files, logs --

def text_lines(spark, sf_dir) -> DataFrame:
    """(file, pos, line): a conversation is a list file, a turn two lines."""
    c = D.table(spark, sf_dir, "conversations")
    t = F.col("turn")
    first = F.when(t == 0, F.concat(F.upper("role"), F.lit(":"))).when(t % 3 == 2, F.lit("  ")).otherwise(
        F.concat(F.lit(" Brand"), (F.length("text") % 7).cast("string"), F.lit(" (x), A, 10 ")))
    second = F.when(t % 4 == 1, F.lit("")).otherwise(
        F.concat(F.lit("brand"), (F.length("text") % 5).cast("string"), F.lit(", B, 5")))
    return c.select(F.col("conv_id").alias("file"), t, F.posexplode(F.array(first, second)).alias("k", "line")).select(
        "file", (t * 2 + F.col("k")).alias("pos"), "line")


@register
def s17_batches(spark, sf_dir):
    """S17 + W12: blank-line separated batches of list files."""
    return disc.batches_from_lines(text_lines(spark, sf_dir)).select("file", "batch_no", "pos", "line")


@register
def u3_training_brands(spark, sf_dir):
    """U3 (O7, P15, F3): brands of two histories, without the newest batch of the first."""
    batches = disc.batches_from_lines(text_lines(spark, sf_dir))
    even = F.col("file") % 2 == 0
    return disc.training_brands(batches.where(even), batches.where(~even), min_size=2).select(
        "source", "file", "batch_no", "pos", "brand")


@register
def s16_report_block(spark, sf_dir):
    """S16 + O8: the report block of the newest log."""
    c = D.table(spark, sf_dir, "conversations")
    t = F.col("turn")
    line = (F.when(t == 0, F.lit("**PRINTING RESULTS** ")).when(t % 7 == 6, F.lit("**FINISHED MAIN PIPELINE**"))
            .when(t % 5 == 4, F.lit("Printed 3 unique discount records.")).otherwise(
                F.concat(F.lit('"'), F.regexp_replace("text", r"[\r\n]", " "), F.lit('"'))))
    lines = c.select((F.col("conv_id") % 9).alias("file"), (F.col("conv_id") * 100 + t).alias("pos"), line.alias("line"))
    return logs.report_block(logs.latest_file(lines)).select("pos", "line")


# --------------------------------------------------- look-ups and ingest --

@register
def j1_code_lookup(spark, sf_dir):
    """A missing code is looked up as ``n/a``, a null code as ``unknown``."""
    li = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    part = D.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(part, li["l_partkey"] == part["p_partkey"])
    code = (F.when(F.col("l_linenumber") % 3 == 0, F.lit(""))
            .when(F.col("l_linenumber") % 3 == 1, F.lit(',"code":null'))
            .otherwise(F.concat(F.lit(',"code":"Q'), F.col("l_quantity").cast("int").cast("string"), F.lit('"'))))
    captions = j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.lit("instagram").alias("platform"),
        F.lit("x").alias("influencer_name"), F.lit("").alias("post_url"),
        F.lit(D.TODAY_TS).cast("timestamp").alias("inserted_at"), F.lower("p_brand").alias("ai_canonical"),
        F.concat(F.lit('[{"webshop":"w"'), code, F.lit(',"percentage":1}]')).alias("ai_analysis")).distinct()
    brands = part.select(F.lower("p_brand").alias("b")).distinct()
    known = disc.known_discounts(brands.select(F.explode(F.array(
        F.struct(F.lit(0).alias("ord"), F.concat("b", F.lit(", N/A, x, 09-01")).alias("line")),
        F.struct(F.lit(1).alias("ord"), F.concat("b", F.lit(", unknown, x, 08-08")).alias("line")),
        F.struct(F.lit(2).alias("ord"), F.concat("b", F.lit(", q7, x, 07-07")).alias("line")))).alias("r")).select("r.*"))
    return report.report_lines(captions, known, with_urls=False, numbered=False).select("line")


def coded_captions(spark, sf_dir) -> DataFrame:
    """Captions with codes, handles and amounts, by document."""
    d = D.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    n, p = (F.col("doc_id") % 90 + 10).cast("string"), (F.col("n_chars") % 60 + 1).cast("string")
    k = F.col("doc_id") % 6
    caption = (
        F.when(k == 0, F.concat(F.lit("use code AAA"), n, F.lit(" for "), p, F.lit("% at @shop.a and code BBB"), n,
                                F.lit(" for "), n, F.lit("% at @shop_b.")))
        .when(k == 1, F.concat(F.lit("My code is LOTTE"), n, F.lit(" enjoy")))
        .when(k == 2, F.concat(F.lit("korting met KIM7, "), p, F.lit("% off")))
        .when(k == 3, F.concat(p, F.lit(" % off at @store with kortingscode: SAVE and code great")))
        .when(k == 4, F.concat(F.lit('coupon "X'), n, F.lit('Y" saves €'), p, F.lit(",50 at 1000% fun, code X"), n,
                               F.lit("Y")))
        .otherwise(F.lit("no discount, encode 5 things")))
    return d.select("doc_id", caption.alias("caption"))


@register
def x1_extract(spark, sf_dir):
    """X1 (F17): codes, shops and amounts of captions, as JSON text."""
    return coded_captions(spark, sf_dir).select("doc_id", extract_analysis_json("caption").alias("analysis"))


@register
def a11_new_rows(spark, sf_dir):
    """A11 (S9 ranks): posts first seen in each run and the running total; runs
    (nations) that add nothing have a row."""
    posts = D.posts(spark, sf_dir).withColumn("ord", F.struct(
        F.format_string("%09d", F.col("ord") % 7 + 1).alias("file"), F.col("ord").alias("pos"), F.lit(0).alias("i")))
    runs = D.table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).cast("int").alias("run_rank"))
    return jobs.new_rows_per_run(posts, runs)


def _stored_and_new(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Normalised posts; those of one creator are already stored."""
    posts = ingest.normalise_posts(D.posts(spark, sf_dir))
    return posts.where(F.col("influencer_name") == "src0"), posts


@register
def k1_archive_insert(spark, sf_dir):
    """K1 + J5 (W1, F2): rows that an insert adds to an archive with posts in it."""
    stored, posts = _stored_and_new(spark, sf_dir)
    return sinks.archive_rows(posts, stored.withColumn("caption_key", key_prefix("caption"))).select(
        "platform", "influencer_name", "caption", "post_url")


@register
def k2_caption_insert(spark, sf_dir):
    """K2 + J5 (P1): keyword captions that an insert adds, numbered after the stored ids."""
    stored, posts = _stored_and_new(spark, sf_dir)
    table = stored.select(F.col("ord").alias("id"), "platform", "post_url", "caption")
    keyword = posts.where(keyword_match("caption", D.INGEST_KEYWORDS))
    return sinks.caption_rows(keyword, table, D.TODAY_TS).select("id", "platform", "influencer_name", "post_url")


@register
def k4_canonical_update(spark, sf_dir):
    """K4 (E3): the caption table after the canonical names of J3 are set."""
    updates = _canonical_updates(spark, sf_dir)
    table = D.captions(spark, sf_dir).select("id", "platform", "ai_canonical")
    return sinks.apply_canonical(table, updates).select("id", "platform", "ai_canonical")


@register
def o1_insert_order(spark, sf_dir):
    """O1 + P3: rows since the cut-off in insert order, with their place."""
    rows = filters.records_since(D.captions(spark, sf_dir), D.REPORT_CUTOFF).select("id", "inserted_at")
    return global_rank(rows, ["inserted_at", "id"], "place").select("id", "place")


@register
def s11_sections(spark, sf_dir):
    """S10, S11 + W11: names under the header "big:" of list files."""
    e = D.table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    k = F.col("event_id") % 10
    line = (F.when(k == 0, F.lit(" Big: ")).when(k == 5, F.lit("SMALL:")).when(k == 7, F.lit(" "))
            .otherwise(F.concat(F.lit(" "), "event_type", F.lit("_"), F.col("user_id").cast("string"))))
    lines = e.select((F.col("event_id") / 1000).cast("long").alias("file"), F.col("event_id").alias("pos"),
                     line.alias("line"))
    return P.section_names(lines, "big").select("file", "pos", "username")
