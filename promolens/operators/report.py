"""New-discount report (E4) and the per-day analysis listings.

The caption table is scanned once; the analysis JSON is parsed once into an
array of structs and exploded; the published list joins on lower-cased
(canonical, code); identical lines are reduced to their first occurrence
with a hash aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import analysis as A
from .dedup import first_per_key
from .ordering import global_rank

def platform_rank():
    """Report sections: instagram first, then tiktok."""
    return F.when(F.col("platform") == "instagram", 0).otherwise(1)


def explode_entries(captions: DataFrame) -> DataFrame:
    """Parse ``ai_analysis`` (F16) once and emit one row per object entry,
    with the list length and the effective canonical name (F19).

    Lists that are absent or empty go after the outer explode: a filter on the
    parsed list (or the one that Spark derives from a plain explode) would be pushed
    below and parse every analysis once more."""
    entries = A.parse_list("ai_analysis")
    parsed = (captions
              .select("id", "platform", "influencer_name", "post_url", "inserted_at", "ai_canonical",
                      entries.alias("_entries"))
              .select("id", "platform", "influencer_name", "post_url", "inserted_at", "ai_canonical",
                      F.size("_entries").alias("n_entries"),
                      A.entry_fields("_entries").alias("_fields")))
    rows = (parsed
            .select("id", "platform", "influencer_name", "post_url", "inserted_at", "n_entries",
                    A.provisional_canonical("ai_canonical", A.first_truthy_webshop_of("_fields")).alias("canonical"),
                    F.explode_outer("_fields").alias("e"))
            .where(F.col("e").isNotNull()))
    return A.entry_texts(rows, "e")


def report_lines(captions: DataFrame, known: DataFrame, with_urls: bool = True,
                 numbered: bool = True) -> DataFrame:
    """Unique report lines (F20 render, W5 first occurrence), in first-seen order.

    ``captions`` holds the rows already selected by the cut-off (P3) and a
    ``platform`` column; one report section per platform, instagram first.
    ``known`` is (canonical_key, code_key, seen_md) from S13.
    Returns (platform, line, first_inserted_at, first_id, first_pos[, line_no]).
    """
    rows = explode_entries(captions.where(F.col("inserted_at").isNotNull()))
    base = F.concat(
        F.when(F.col("n_entries") > 1, F.lit("MULTI__")).otherwise(F.lit("")),
        F.lit('"'), F.col("canonical"), F.lit(", "), F.col("code_display"), F.lit(", "),
        F.col("pct_display"), F.lit(", "), A.display_influencer("influencer_name", "platform"),
        F.lit(", "), F.date_format("inserted_at", "MM-dd"), F.lit('",'))
    keyed = rows.select("platform", "post_url", "inserted_at", "id", "pos", base.alias("base"),
                        F.lower("canonical").alias("canonical_key"),
                        A.lookup_code(F.col("code"), F.col("code_display")).alias("code_key"))
    # Published list look-up; small in practice, AQE turns this into a broadcast join
    # when its runtime size allows, a sort-merge join otherwise
    flagged = keyed.join(known, ["canonical_key", "code_key"], "left")
    line = F.when(F.col("seen_md").isNotNull(),
                  F.concat(F.lit("..."), F.col("base"), F.lit(".........."), F.col("seen_md"))
                  ).otherwise(F.col("base"))
    if with_urls:
        line = F.when(F.coalesce(F.col("post_url"), F.lit("")) != "",
                      F.concat(line, F.lit("    "), F.col("post_url"))).otherwise(line)
    lines = flagged.select("platform", line.alias("line"),
                           F.col("inserted_at").alias("first_inserted_at"),
                           F.col("id").alias("first_id"), F.col("pos").alias("first_pos"))
    unique = first_per_key(lines, ["platform", "line"], ["first_inserted_at", "first_id", "first_pos"])
    if not numbered:
        return unique
    return global_rank(unique.withColumn("_prank", platform_rank()),
                       ["_prank", "first_inserted_at", "first_id", "first_pos"], "line_no").drop("_prank")


def unique_webshop_codes(captions: DataFrame) -> DataFrame:
    """First entry per (webshop, code) (NULLs equal) with that row's
    influencer; order = (inserted_at, id, entry position)."""
    rows = explode_entries(captions)
    return first_per_key(rows.select("webshop", "code", "percentage", "webshop_csv", "code_csv",
                                     "influencer_name", "inserted_at", "id", "pos"),
                         ["webshop", "code"], ["inserted_at", "id", "pos"])


def csv_style_lines(entries: DataFrame, today: dt.date) -> DataFrame:
    """F21 over W3 output."""
    md = F.lit(today.strftime("%m-%d"))
    return entries.select("*", A.csv_style(F.col("webshop_csv"), F.col("code_csv"), F.col("percentage"),
                                           F.col("influencer_name"), md).alias("line"))


def webshops_to_resolve(captions: DataFrame, exploded: DataFrame | None = None) -> DataFrame:
    """A1: distinct truthy webshop names of rows without canonical name
    (pass ``exploded`` = ``explode_entries`` output to reuse a parse)."""
    rows = exploded if exploded is not None else explode_entries(captions.where(F.col("ai_canonical").isNull()))
    return rows.where(A.truthy_text(F.col("webshop"))).select("webshop").distinct()


def unresolved_entries(captions: DataFrame) -> DataFrame:
    """Exploded entries of rows without canonical name (id, inserted_at,
    webshop, ...), parsed once for A1 and J3."""
    return explode_entries(captions.where(F.col("ai_canonical").isNull()))
