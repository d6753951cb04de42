"""Discount-analysis JSON: parse, inspect and render (Column -> Column).

An analysis value is JSON text holding a list of objects
``{webshop, code, percentage}``. Only a top-level list counts; elements
that are not objects are skipped but still count for the list length.
Parsing goes through VARIANT (``try_parse_json``), which keeps the
difference between a missing key and a JSON null and never raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from .text import _col

ENTRY_FIELDS = ("webshop", "code", "percentage")


def parse_list(c) -> Column:
    """F16: ``array<variant>`` for a JSON list; NULL for NULL, '', bad JSON,
    JSON null and any non-list value."""
    return F.try_variant_get(F.try_parse_json(_col(c)), "$", "array<variant>")


def is_object(e: Column) -> Column:
    return F.try_variant_get(e, "$", "map<string,variant>").isNotNull()


def object_entries(entries) -> Column:
    """Only the object elements of a parsed list."""
    return F.filter(_col(entries), is_object)


def field_variant(e: Column, name: str) -> Column:
    """The field as VARIANT; NULL when the key is missing."""
    return F.variant_get(e, f"$.{name}", "variant")


def field_missing(e: Column, name: str) -> Column:
    return field_variant(e, name).isNull()


def field_is_null(e: Column, name: str) -> Column:
    return F.coalesce(F.is_variant_null(field_variant(e, name)), F.lit(False))


def _raw_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _like_python(text: Column, v: Column) -> Column:
    """The ``_raw_text`` of ``v``, booleans as Python prints them."""
    boolean = text.isin("true", "false") & (F.schema_of_variant(v) == "BOOLEAN")
    return F.when(boolean, F.initcap(text)).otherwise(text)


def _text_of(v: Column) -> Column:
    """A field VARIANT as text: NULL for SQL NULL (missing) and JSON null;
    booleans print like Python (``True``/``False``); objects/arrays as JSON."""
    return _like_python(_raw_text(v), v)


def _display_of(v: Column, missing: str) -> Column:
    """``str(entry.get(name, missing))``: missing key -> ``missing``, JSON
    null -> ``None``."""
    return (F.when(v.isNull(), F.lit(missing))
            .when(F.coalesce(F.is_variant_null(v), F.lit(False)), F.lit("None"))
            .otherwise(_text_of(v)))


def field_text(e: Column, name: str) -> Column:
    """Field value as text (NULL when missing or JSON null)."""
    return _text_of(field_variant(e, name))


def field_display(e: Column, name: str, missing: str = "N/A") -> Column:
    return _display_of(field_variant(e, name), missing)


def truthy_text(t: Column) -> Column:
    """Python truthiness of a JSON scalar rendered as text."""
    return t.isNotNull() & (t != "") & (t != "0") & (t != "False") & (t != "0.0")


def entry_fields(entries) -> Column:
    """Object elements as ``array<struct<pos, obj, w, w_text, c, p>>``: position, the field
    VARIANTs of webshop, code and percentage, and the webshop's ``_raw_text``, which is read
    twice (by the canonical name and by the entry)."""
    raw = F.transform(_col(entries), lambda e, i: F.struct(
        i.alias("pos"),
        is_object(e).alias("obj"),
        field_variant(e, "webshop").alias("w"),
        _raw_text(field_variant(e, "webshop")).alias("w_text"),
        field_variant(e, "code").alias("c"),
        field_variant(e, "percentage").alias("p")))
    return F.filter(raw, lambda s: s["obj"])


def entries_struct(entries) -> Column:
    """The same elements with their texts: ``array<struct<pos, webshop, code, percentage,
    code_display, pct_display, webshop_csv, code_csv>>``."""
    return F.transform(entry_fields(entries), lambda s: F.struct(
        s["pos"].alias("pos"),
        _text_of(s["w"]).alias("webshop"),
        _text_of(s["c"]).alias("code"),
        _text_of(s["p"]).alias("percentage"),
        _display_of(s["c"], "N/A").alias("code_display"),
        _display_of(s["p"], "N/A").alias("pct_display"),
        _display_of(s["w"], "").alias("webshop_csv"),
        _display_of(s["c"], "").alias("code_csv")))


def entry_texts(rows: DataFrame, entry: str) -> DataFrame:
    """The fields of column ``entry`` (one of ``entry_fields``) as columns ``pos, webshop, code,
    percentage, code_display, pct_display, webshop_csv, code_csv``, in place of it.

    Works on single entries, and on texts that are columns of their own: lambdas over
    whole lists are interpreted, and either way a field's text would be found anew for
    every use."""
    def shown(name: str, text: str, missing: str) -> Column:
        return F.coalesce(text, F.when(F.col(f"{entry}.{name}").isNull(), F.lit(missing)).otherwise("None"))
    names = {"webshop": "w", "code": "c", "percentage": "p"}
    raw = rows.select("*", F.col(f"{entry}.pos").alias("pos"), F.col(f"{entry}.w_text").alias("_t_webshop"),
                      *[_raw_text(F.col(f"{entry}.{names[n]}")).alias(f"_t_{n}") for n in ("code", "percentage")])
    texts = raw.select("*", *[_like_python(F.col(f"_t_{n}"), F.col(f"{entry}.{v}")).alias(n)
                              for n, v in names.items()]).drop(*[f"_t_{n}" for n in names])
    return texts.select("*", shown("c", "code", "N/A").alias("code_display"),
                        shown("p", "percentage", "N/A").alias("pct_display"),
                        shown("w", "webshop", "").alias("webshop_csv"),
                        shown("c", "code", "").alias("code_csv")).drop(entry)


def first_truthy_webshop_of(fields) -> Column:
    """W13 over ``entry_fields`` output."""
    shops = F.transform(_col(fields), lambda x: _like_python(x["w_text"], x["w"]))
    return F.get(F.filter(shops, truthy_text), 0)


def first_truthy_webshop(entries) -> Column:
    """Webshop of the first object element whose webshop is truthy."""
    return first_truthy_webshop_of(entry_fields(entries))


def provisional_canonical(canonical, shop: Column) -> Column:
    """F19 given the first truthy webshop."""
    can = _col(canonical)
    provisional = F.concat(F.lit("___"), F.lower(F.replace(shop, F.lit(" "), F.lit(""))))  # NULL without a shop
    unset = can.isNull() | (can == "") | (F.upper(can) == "UNKNOWN")
    return F.when(unset, F.coalesce(provisional, F.lit("UNKNOWN"))).otherwise(can)


def effective_canonical(canonical, entries) -> Column:
    """keep a set canonical name; when it is empty or UNKNOWN use
    ``___`` + first truthy webshop (spaces removed, lower) or UNKNOWN."""
    return provisional_canonical(canonical, first_truthy_webshop(entries))


def lookup_code(code_text: Column, code_display: Column) -> Column:
    """Lower-case code for the published-list look-up: a missing key is looked
    up like it is displayed (``n/a``), a null or empty code as ``unknown``."""
    missing = code_text.isNull() & (code_display == "N/A")
    return F.lower(F.when(truthy_text(code_text) | missing, code_display).otherwise(F.lit("unknown")))


def load_model_output(raw) -> Column:
    """Trimmed model response -> VARIANT; NULL when not valid JSON or
    JSON null (the row then stays unanalysed)."""
    v = F.try_parse_json(F.trim(_col(raw)))
    return F.when(v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(False)), v)


def analysed(rows: DataFrame) -> DataFrame:
    """X2 + F17: model answers ``raw`` as ``ai_analysis``, their JSON text; rows
    whose answer is no JSON or null are left out.

    The text comes out of an outer explode: a filter on it is not pushed below, where
    it would run the extraction once more for every row."""
    text = F.to_json(load_model_output("raw"))
    return (rows.select(*[c for c in rows.columns if c != "raw"], F.explode_outer(F.array(text)).alias("ai_analysis"))
            .where(F.col("ai_analysis").isNotNull()))


def to_json_text(v) -> Column:
    """serialise (UTF-8, no ASCII escaping)."""
    return F.to_json(_col(v))


def csv_style(webshop: Column, code: Column, pct: Column, influencer: Column, md: Column) -> Column:
    """``"webshop, code, pct, influencer, MM-dd"``. ``webshop`` and
    ``code`` are display texts ('' when missing, ``None`` when null); a
    missing or null percentage renders as ''; a null influencer as ``None``."""
    return F.concat(F.lit('"'), F.concat_ws(", ", webshop, code, F.coalesce(pct, F.lit("")),
                                            F.coalesce(influencer, F.lit("None")), md), F.lit('"'))


def display_influencer(name, platform) -> Column:
    n = F.coalesce(_col(name), F.lit("None"))
    return F.when(_col(platform) == "tiktok", F.concat(n, F.lit(rules.TIKTOK_SUFFIX))).otherwise(n)
