"""Discount extraction from caption text (X1), native Spark expressions.

Replaces the hosted-model call with rules that meet the same output
contract: a JSON list of ``{webshop, code, percentage}``; a percentage is a
number, or a euro amount kept as text with ``€``; when the text names no
amount, trailing digits of the code are used (``SUMMER20`` -> 20); no code
found -> ``[]``. Equal in contract, not in the model's judgement.

Rules (all regular expressions, evaluated by the JVM):
* the caption is split where a cue begins; every part but the first starts
  with its cue and may hold one code;
* code: a token of 3+ letters/digits/``_-`` after the cue (``code``, ``kode``,
  ``coupon``, compounds such as ``kortingscode``, or ``korting met`` and the
  like), optionally after a filling word, ``:``/``=`` and a quote; it must
  contain a digit or be upper case; the first mention of a code counts;
* webshop and amount: a caption either names them before its codes (its first
  part then holds one) or after them. Accordingly the last one of the text
  before, or the first one of the code's own part, is taken, and the other
  side where that has none;
* percentage: ``N%`` or ``€N``, else the code's trailing digits, else NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

# --- fixed values: cue words and patterns of the rule-based extractor ---
CUE = r"(?:code|kode|coupon|korting\s+met|discount\s+with|rabatt\s+mit)"
CODE_PATTERN = r"(?i)" + CUE + r"(?:\s+(?:is|ist|est|es|met|mit|with|avec)\b)?" + (
    r"\s*[:=]?\s*[\"'“”‘’]?([A-Za-z0-9][A-Za-z0-9_\-]{2,})")
HANDLE = r"@([A-Za-z0-9._]*[A-Za-z0-9_])"
AMOUNT = r"([0-9]+\s?%|€\s?[0-9]+(?:[.,][0-9]+)?)"
TRAILING_DIGITS = r"([0-9]+)$"


def _first(part: Column, pattern: str) -> Column:
    found = F.regexp_extract(part, pattern, 1)
    return F.when(found != "", found)


def _last(part: Column, pattern: str) -> Column:
    return F.get(F.reverse(F.regexp_extract_all(part, F.lit(pattern), F.lit(1))), 0)


def _amount_json(amount: Column, code: Column) -> Column:
    """JSON text of the percentage."""
    digits = F.regexp_replace(F.coalesce(F.when(amount.endswith("%"), amount), _first(code, TRAILING_DIGITS)),
                              r"[\s%]|^0+(?=[0-9])", "")
    euro = F.concat(F.lit('"€'), F.regexp_replace(amount, r"[€\s]", ""), F.lit('"'))
    return F.when(amount.startswith("€"), euro).otherwise(F.coalesce(digits, F.lit("null")))


def extract_entries(caption) -> Column:
    """``array<struct<webshop string, code string, percentage variant>>``; empty without codes."""
    text = F.coalesce(_col(caption), F.lit(""))
    # a one-element transform: its parameter is the split text, made once however often it is used
    found = F.get(F.transform(F.array(F.split(text, f"(?i)(?={CUE})")), _entries_of), 0)
    # most captions hold no code: one look at the text settles those
    return F.when(text.rlike(CODE_PATTERN), found).otherwise(
        F.array().cast("array<struct<webshop string, code string, percentage variant>>"))


def _entries_of(parts: Column) -> Column:
    """The entries of a caption split where its cues begin."""
    opening = F.get(parts, 0)
    # a caption that opens with its cue has nothing before its codes
    head = F.when(opening.rlike(f"(?i)^{CUE}"), F.lit("")).otherwise(opening)
    shop_before, amount_before = head.rlike(HANDLE), head.rlike(AMOUNT)

    def near(own: Column, i: Column, pattern: str, before_style: Column) -> Column:
        own_one, earlier = _first(own, pattern), _last(F.array_join(F.slice(parts, 1, i), ""), pattern)
        return F.when(before_style, F.coalesce(earlier, own_one)).otherwise(F.coalesce(own_one, earlier))
    raw = F.transform(parts, lambda s, i: F.struct(
        F.regexp_extract(s, "^" + CODE_PATTERN, 1).alias("code"),
        near(s, i, HANDLE, shop_before).alias("webshop"),
        near(s, i, AMOUNT, amount_before).alias("amount")))
    good = F.filter(raw, lambda e: (e["code"] != "") & (e["code"].rlike("[0-9]") | (e["code"] == F.upper(e["code"]))))
    codes = F.transform(good, lambda e: e["code"])
    first = F.filter(good, lambda e, i: F.array_position(codes, e["code"]) == i + 1)
    return F.transform(first, lambda e: F.struct(
        e["webshop"].alias("webshop"), e["code"].alias("code"),
        F.parse_json(_amount_json(e["amount"], e["code"])).alias("percentage")))


def extract_analysis_json(caption) -> Column:
    """X1 as JSON text (nulls kept as JSON null), ``[]`` when nothing found."""
    return F.to_json(extract_entries(caption), {"ignoreNullFields": "false"})
