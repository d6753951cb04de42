"""DuckDB oracle SQL for the registered queries.

The oracle derives the same inputs from the benchmark tables as
``plans/driver.py`` but works on the line items relationally (no JSON), so
it checks the JSON build/parse path end to end.
"""

from __future__ import annotations

from . import driver as D


def _ts(value) -> str:
    return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"


# Derived inputs shared by the caption-table queries.
BASE = f"""
li AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice, l.l_quantity,
         l.l_returnflag, l.l_linestatus, l.l_shipdate, p.p_brand, p.p_type, p.p_size,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE p_brand END AS e_webshop,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
              ELSE upper(p_type) || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS e_code,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL
              ELSE CAST(l_quantity AS INTEGER) END AS e_pct
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
ent AS (
  SELECT li.*,
         CAST(row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS pos,
         count(*) OVER (PARTITION BY l_orderkey) AS n_entries
  FROM li),
prov AS (
  SELECT l_orderkey, arg_min(e_webshop, pos) AS shop
  FROM ent WHERE e_webshop IS NOT NULL AND e_webshop <> '' GROUP BY l_orderkey),
cap AS (
  SELECT o.o_orderkey AS id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'tiktok' ELSE 'instagram' END AS platform,
         c.c_name AS influencer_name,
         'order ' || o_orderpriority || ' ' || o_orderstatus AS caption,
         'https://shop.example/p/' || CAST(o.o_custkey AS VARCHAR) AS post_url,
         o.o_orderdate AS post_date,
         o.o_orderdate AS inserted_at,
         CASE WHEN f.l_orderkey IS NULL THEN 'none' WHEN o_orderpriority = '5-LOW' THEN 'object'
              ELSE 'list' END AS analysis_kind,
         CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'UNKNOWN' ELSE lower(f.p_brand) END AS ai_canonical
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, p_brand FROM ent WHERE pos = 0) f ON o.o_orderkey = f.l_orderkey),
pub AS (
  SELECT lower(p_brand) || ' (promo ' || CAST(p_size AS VARCHAR) || '), ' || upper(p_type)
           || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ', ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
           || ', x, ' || strftime(l_shipdate, '%m-%d') AS line,
         date_diff('day', l_shipdate, DATE '2100-01-01') AS age,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM li WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
known AS (
  SELECT canonical_key, code_key, seen_md FROM (
    SELECT lower(trim(split_part(trim(split_part(line, ',', 1)), '(', 1))) AS canonical_key,
           lower(trim(split_part(line, ',', 2))) AS code_key,
           trim(list_last(string_split(line, ','))) AS seen_md,
           row_number() OVER (PARTITION BY lower(trim(split_part(trim(split_part(line, ',', 1)), '(', 1))),
                                           lower(trim(split_part(line, ',', 2)))
                              ORDER BY age, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM pub) WHERE rn = 1)
"""

REPORT = f"""
rep_rows AS (
  SELECT cap.*, ent.pos, ent.n_entries, ent.e_code, ent.e_pct,
         CASE WHEN cap.ai_canonical IS NULL OR cap.ai_canonical = '' OR upper(cap.ai_canonical) = 'UNKNOWN'
              THEN coalesce('___' || lower(replace(prov.shop, ' ', '')), 'UNKNOWN')
              ELSE cap.ai_canonical END AS canonical
  FROM cap JOIN ent ON ent.l_orderkey = cap.id
  LEFT JOIN prov ON prov.l_orderkey = cap.id
  WHERE cap.analysis_kind = 'list' AND cap.inserted_at > {_ts(D.REPORT_CUTOFF)}),
rep_base AS (
  SELECT platform, post_url, inserted_at, id, pos,
         CASE WHEN n_entries > 1 THEN 'MULTI__' ELSE '' END || '"' || canonical || ', '
           || coalesce(e_code, 'None') || ', ' || coalesce(CAST(e_pct AS VARCHAR), 'None') || ', '
           || coalesce(influencer_name, 'None') || CASE WHEN platform = 'tiktok' THEN '_tiktok' ELSE '' END
           || ', ' || strftime(inserted_at, '%m-%d') || '",' AS base,
         lower(canonical) AS canonical_key,
         lower(CASE WHEN e_code IS NULL OR e_code = '' THEN 'unknown' ELSE e_code END) AS code_key
  FROM rep_rows),
rep_lines AS (
  SELECT b.platform,
         CASE WHEN k.seen_md IS NOT NULL THEN '...' || b.base || '..........' || k.seen_md ELSE b.base END
           || CASE WHEN coalesce(b.post_url, '') <> '' THEN '    ' || b.post_url ELSE '' END AS line,
         b.inserted_at, b.id, b.pos
  FROM rep_base b LEFT JOIN known k ON b.canonical_key = k.canonical_key AND b.code_key = k.code_key),
rep_unique AS (
  SELECT platform, line, inserted_at AS first_inserted_at, id AS first_id, pos AS first_pos FROM (
    SELECT *, row_number() OVER (PARTITION BY platform, line ORDER BY inserted_at, id, pos) AS rn
    FROM rep_lines) WHERE rn = 1),
report AS (
  SELECT *, row_number() OVER (ORDER BY CASE WHEN platform = 'instagram' THEN 0 ELSE 1 END,
                                        first_inserted_at, first_id, first_pos) AS line_no
  FROM rep_unique)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


ORACLE: dict[str, str] = {
    "e4_report_lines": _with(BASE, REPORT) + """
SELECT platform, line, first_inserted_at, first_id, first_pos, line_no FROM report""",
}

# --------------------------------------------------- caption-table reads --

def _since(extra: str = "") -> str:
    return f"SELECT * FROM cap WHERE inserted_at > {_ts(D.REPORT_CUTOFF)} {extra}"


# Text of a parsed entry field as Spark renders it (VARIANT cast to string).
ENTRY_ROWS = f"""
entry_rows AS (
  SELECT cap.id, cap.influencer_name, cap.inserted_at, ent.pos, ent.e_webshop AS webshop, ent.e_code AS code,
         CAST(ent.e_pct AS VARCHAR) AS percentage, cap.ai_canonical
  FROM cap JOIN ent ON ent.l_orderkey = cap.id
  WHERE cap.analysis_kind = 'list' AND cap.inserted_at > {_ts(D.REPORT_CUTOFF)})
"""

ORACLE.update({
    "p2_records_for_date": _with(BASE) + f"""
SELECT id, influencer_name, post_url, post_date, inserted_at, ai_canonical FROM cap
WHERE CAST(inserted_at AS DATE) = DATE '{D.ANALYSIS_DAY:%Y-%m-%d}' AND post_date > {_ts(D.POST_DATE_AFTER)}
  AND platform = 'instagram'""",
    "p3_records_since": _with(BASE) + f"""
SELECT id, platform, influencer_name, post_url, inserted_at,
       analysis_kind <> 'none' AS has_analysis
FROM cap WHERE inserted_at > {_ts(D.REPORT_CUTOFF)} AND post_date > {_ts(D.POST_DATE_AFTER)}""",
    "p5_not_analysed": _with(BASE) + f"""
SELECT id, platform, coalesce(caption, '') AS caption, post_url FROM ({_since()}) WHERE analysis_kind = 'none'""",
    "p6_with_analysis": _with(BASE) + f"""
, obj AS (SELECT l_orderkey, pos, '{{"code":' || coalesce('"' || e_code || '"', 'null') || ',"percentage":'
            || coalesce(CAST(e_pct AS VARCHAR), 'null') || ',"webshop":' || coalesce('"' || e_webshop || '"', 'null') || '}}' AS o FROM ent),
txt AS (SELECT l_orderkey, '[' || string_agg(o, ',' ORDER BY pos) || ']' AS list_text, arg_min(o, pos) AS first_text
        FROM obj GROUP BY l_orderkey)
SELECT row_number() OVER (ORDER BY inserted_at, id) AS item_no, count(*) OVER () AS item_total,
       id, influencer_name, post_url, post_date, caption,
       CASE analysis_kind WHEN 'object' THEN first_text ELSE list_text END AS analysis_text
FROM ({_since()}) JOIN txt ON id = l_orderkey WHERE analysis_kind <> 'none'""",
    "a1_webshops_to_resolve": _with(BASE, ENTRY_ROWS) + """
SELECT DISTINCT webshop FROM entry_rows WHERE ai_canonical IS NULL AND webshop IS NOT NULL AND webshop <> ''""",
    "w3_unique_webshop_codes": _with(BASE, ENTRY_ROWS) + f"""
SELECT webshop, code, percentage, influencer_name, id, pos,
       '"' || coalesce(webshop, 'None') || ', ' || coalesce(code, 'None') || ', ' || coalesce(percentage, '')
         || ', ' || coalesce(influencer_name, 'None') || ', {D.TODAY:%m-%d}"' AS line
FROM (SELECT *, row_number() OVER (PARTITION BY webshop, code ORDER BY inserted_at, id, pos) AS rn
      FROM entry_rows) WHERE rn = 1""",
    "s13_known_discounts": _with(BASE) + """
SELECT canonical_key, code_key, seen_md FROM known""",
    "s14_names_from_discounts": _with(BASE) + """
SELECT DISTINCT trim(regexp_replace(trim(split_part(line, ',', 1)), '\\s*\\(.*?\\)', '', 'g')) AS name
FROM pub WHERE trim(regexp_replace(trim(split_part(line, ',', 1)), '\\s*\\(.*?\\)', '', 'g')) <> ''""",
    "s15_keys_from_source": """
SELECT DISTINCT unnest(regexp_extract_all(props, '["'']([^"'']+)["'']\\s*:', 1)) AS name FROM events""",
    "a2_known_names": _with(BASE) + """
SELECT DISTINCT name FROM (
  SELECT trim(regexp_replace(trim(split_part(line, ',', 1)), '\\s*\\(.*?\\)', '', 'g')) AS name FROM pub
  UNION ALL
  SELECT unnest(regexp_extract_all(props, '["'']([^"'']+)["'']\\s*:', 1)) AS name FROM events) WHERE name <> ''""",
})

# ------------------------------------------------------- caption ingest ---

# NFKD of the accented letters present in the documents table (letter +
# combining mark); every other character there is ASCII or 'ß' (no
# decomposition).
_NFKD_PAIRS = [("é", "é"), ("è", "è"), ("ê", "ê"), ("ü", "ü"), ("ö", "ö"),
               ("ä", "ä"), ("ó", "ó"), ("í", "í"), ("ñ", "ñ"), ("ç", "ç"),
               ("É", "É"), ("È", "È"), ("Ê", "Ê"), ("Ü", "Ü"), ("Ö", "Ö"),
               ("Ä", "Ä"), ("Ó", "Ó"), ("Í", "Í"), ("Ñ", "Ñ"), ("Ç", "Ç")]


def _nfkd_sql(expr: str) -> str:
    for a, b in _NFKD_PAIRS:
        expr = f"replace({expr}, '{a}', '{b}')"
    return f"trim(regexp_replace({expr}, ' +', ' ', 'g'), ' \n')"


def _keyword_sql(expr: str) -> str:
    return "(" + " OR ".join(f"contains(lower({expr}), '{k.lower()}')" for k in D.INGEST_KEYWORDS) + ")"


POSTS = f"""
posts AS (
  SELECT CASE WHEN lang IN ('en', 'de') THEN 'instagram' ELSE 'tiktok' END AS platform,
         source AS influencer_name, {_nfkd_sql('text')} AS caption,
         'https://post/' || CAST(n_chars % 50 AS VARCHAR) AS post_url,
         CAST(DATE '2025-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS post_date,
         doc_id AS ord
  FROM documents),
archive AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform, post_url, caption ORDER BY ord) rn
                 FROM posts) WHERE rn = 1),
kw AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform, post_url, caption ORDER BY ord) rn
                 FROM posts WHERE {_keyword_sql('caption')}) WHERE rn = 1)
"""

ORACLE.update({
    "f1_normalize_captions": f"SELECT doc_id, {_nfkd_sql('text')} AS caption FROM documents",
    "p1_keyword_filter": f"SELECT doc_id, {_keyword_sql(_nfkd_sql('text'))} AS matched FROM documents",
    "w1_archive_records": _with(POSTS) + """
SELECT platform, influencer_name, caption, post_url, post_date FROM archive""",
    "k2_keyword_records": _with(POSTS) + """
SELECT platform, influencer_name, caption, post_url, post_date FROM kw""",
    "a4_ingest_counts": _with(POSTS) + """
SELECT p.platform, p.users, p.posts, coalesce(a.n, 0) AS archived, coalesce(k.n, 0) AS keyword_rows
FROM (SELECT platform, count(DISTINCT influencer_name) AS users, count(*) AS posts FROM posts GROUP BY 1) p
LEFT JOIN (SELECT platform, count(*) AS n FROM archive GROUP BY 1) a ON a.platform = p.platform
LEFT JOIN (SELECT platform, count(*) AS n FROM kw GROUP BY 1) k ON k.platform = p.platform""",
    "a8_raw_vs_unique": _with(POSTS) + """
SELECT platform, count(*) AS raw, count(DISTINCT (post_url, caption)) AS unique_posts
FROM posts GROUP BY platform""",
})

# --------------------------------------------------- publication filter ---

_R = D.PUBLISH_RULES
_Q = "'\"[^\"]*\"'"           # first quoted part present
_QI = "'\"([^\"]*)\"'"        # its inner text


def _fields(expr: str) -> str:
    return f"list_transform(string_split(regexp_extract({expr}, {_QI}, 1), ','), lambda x: trim(x))"


def _case_map(key: str, mapping: dict, default: str = "NULL") -> str:
    if not mapping:
        return default
    arms = " ".join(f"WHEN '{k}' THEN {v!r}" if isinstance(v, str) else f"WHEN '{k}' THEN {v}"
                    for k, v in mapping.items())
    return f"CASE {key} {arms} ELSE {default} END"


def _replace_quoted(line: str, new_inner: str) -> str:
    return (f"(split_part({line}, '\"', 1) || '\"' || {new_inner} || '\"' || "
            f"substr({line}, length(split_part({line}, '\"', 1)) + length(regexp_extract({line}, {_QI}, 1)) + 3))")


def _u(tag: str, expr: str) -> str:
    return f"(('0x' || substr(md5('{D.SEED}:{tag}:' || CAST({expr} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


_DEFAULT_SQL = _case_map("lower(regexp_replace(p[1], '^_+', ''))", _R["default_values"], "'10'")
_PREV = r"'\.{10}(\d{2})-(\d{2})'"
_TODAY = f"DATE '{D.TODAY:%Y-%m-%d}'"
_IGN = ", ".join(f"'{b}'" for b in _R["ignored_brands"])
_BOOST = ", ".join(f"'{b}'" for b in _R["boosted_brands"])

PUBLISH = f"""
cls_in AS (
  SELECT line_no AS ord, line, regexp_matches(line, {_Q}) AS q, {_fields('line')} AS f FROM report),
cls_k AS (
  SELECT *, lower(regexp_replace(f[1], '^_+', '')) AS brand_key,
         CASE WHEN regexp_matches(line, {_PREV}) THEN
           CASE WHEN try_strptime('{D.TODAY.year}-' || regexp_extract(line, {_PREV}, 1) || '-' || regexp_extract(line, {_PREV}, 2), '%Y-%m-%d')::DATE > {_TODAY}
                THEN try_strptime('{D.TODAY.year - 1}-' || regexp_extract(line, {_PREV}, 1) || '-' || regexp_extract(line, {_PREV}, 2), '%Y-%m-%d')::DATE
                ELSE try_strptime('{D.TODAY.year}-' || regexp_extract(line, {_PREV}, 1) || '-' || regexp_extract(line, {_PREV}, 2), '%Y-%m-%d')::DATE END
         END AS prev
  FROM cls_in),
cls AS (
  SELECT ord, line,
    CASE WHEN contains(line, '"UNKNOWN,') THEN 'unknown'
         WHEN q AND brand_key IN ({_IGN}) THEN 'ignored'
         WHEN q AND len(f) >= 2 AND {_case_map('brand_key', _R['min_code_length'])} IS NOT NULL
              AND length(f[2]) < {_case_map('brand_key', _R['min_code_length'])} THEN 'short_code'
         WHEN q AND len(f) >= 2 AND lower(f[2]) = 'none' THEN 'missing_code'
         WHEN starts_with(line, '...') AND prev IS NOT NULL AND date_diff('day', prev, {_TODAY}) < 21 THEN 'recent'
         ELSE 'keep' END AS reason
  FROM cls_k),
r1 AS (
  SELECT ord, starts_with(line, '...') AS stripped,
         CASE WHEN starts_with(line, '...') THEN substr(line, 4) ELSE line END AS line
  FROM cls WHERE reason = 'keep'),
r1f AS (SELECT *, regexp_matches(line, {_Q}) AS q1, {_fields('line')} AS f1 FROM r1),
r2 AS (
  SELECT ord, stripped, (NOT contains(line, 'MULTI__') AND q1 AND starts_with(f1[1], '___')) AS cleaned,
         CASE WHEN NOT contains(line, 'MULTI__') AND q1 AND starts_with(f1[1], '___')
              THEN {_replace_quoted('line', "array_to_string(list_concat([regexp_replace(lower(substr(f1[1], 4)), '[^a-z0-9._]', '', 'g')], f1[2:]), ', ')")}
              ELSE line END AS line
  FROM r1f),
r2f AS (SELECT *, regexp_matches(line, {_Q}) AND len({_fields('line')}) >= 3 AS has3, {_fields('line')} AS p FROM r2),
r2v AS (
  SELECT *, lower(p[3]) = 'none' AS is_none,
         regexp_full_match(p[3], '€?(\\d+(?:\\.\\d+)?)%?') AS ok,
         TRY_CAST(regexp_extract(p[3], '^€?(\\d+(?:\\.\\d+)?)%?$', 1) AS DOUBLE) AS num,
         starts_with(p[3], '€') AS euro
  FROM r2f),
r3 AS (
  SELECT ord, stripped, cleaned, coalesce(has3 AND is_none, false) AS defaulted,
         coalesce(has3 AND NOT is_none AND (NOT ok OR CASE WHEN euro THEN num > {float(100)} ELSE num > {float(40)} END), false) AS marked,
         CASE WHEN has3 THEN {_replace_quoted('line', f"CASE WHEN is_none THEN array_to_string(list_concat(p[1:2], [{_DEFAULT_SQL}], p[4:]), ', ') ELSE array_to_string(p, ', ') END")}
              ELSE line END AS line
  FROM r2v),
r3b AS (
  SELECT ord, stripped, cleaned, defaulted, marked,
         CASE WHEN marked AND NOT starts_with(line, 'REVIEW_') THEN 'REVIEW_HIGH__' || line ELSE line END AS line
  FROM r3),
m AS (SELECT *, contains(line, 'MULTI__') AS is_multi, nullif(regexp_extract(line, 'https?://\\S+', 0), '') AS url FROM r3b),
m_win AS (
  SELECT ord, line, is_multi FROM m WHERE NOT (is_multi AND url IS NOT NULL)
  UNION ALL
  SELECT ord, line, is_multi FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord) AS rn FROM m WHERE is_multi AND url IS NOT NULL)
  WHERE rn = 1),
kept AS (
  SELECT ord, is_multi,
         CASE WHEN is_multi AND strpos(line, 'MULTI__') > 0
              THEN substr(line, 1, strpos(line, 'MULTI__') - 1) || substr(line, strpos(line, 'MULTI__') + 7)
              ELSE line END AS line
  FROM m_win),
kd AS (SELECT *, regexp_matches(line, {_Q}) AND len({_fields('line')}) >= 2 AS keyed,
              lower({_fields('line')}[1]) AS b, lower({_fields('line')}[2]) AS c FROM kept),
surv AS (
  SELECT ord, line FROM kd WHERE NOT keyed
  UNION ALL
  SELECT ord, line FROM (
    SELECT *, row_number() OVER (PARTITION BY b, c ORDER BY md5('{D.SEED}:' || CAST(ord AS VARCHAR)), ord) AS rn
    FROM kd WHERE keyed) WHERE rn = 1),
hist AS (
  SELECT lower(p_brand) AS brand, l_orderkey // 100 AS batch_no,
         row_number() OVER (PARTITION BY l_orderkey // 100
                            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS idx,
         count(*) OVER (PARTITION BY l_orderkey // 100) AS batch_size
  FROM li),
avgpos AS (
  SELECT brand, avg(first_idx) AS avg_pos FROM (
    SELECT batch_no, brand, min(idx) AS first_idx FROM hist
    GROUP BY batch_no, brand) GROUP BY brand),
sb AS (
  SELECT ord, line,
         CASE WHEN regexp_matches(pl, {_Q}) THEN lower(trim(split_part(regexp_extract(pl, {_QI}, 1), ',', 1))) ELSE '' END AS brand
  FROM (SELECT *, CASE WHEN starts_with(line, 'REVIEW_') AND strpos(line, '__') > 0
                       THEN substr(line, strpos(line, '__') + 2) ELSE line END AS pl FROM surv)),
sp AS (
  SELECT sb.*, brand = '' OR ord = min(ord) OVER (PARTITION BY brand) AS is_primary,
         CASE WHEN brand IN ({_BOOST}) THEN 4.0 + {_u('boost', 'brand')} ELSE a.avg_pos END AS score
  FROM sb LEFT JOIN avgpos a USING (brand)),
srt AS (
  SELECT *, row_number() OVER (ORDER BY score, ord) AS r, count(*) OVER () AS n
  FROM sp WHERE is_primary AND brand <> '' AND score IS NOT NULL),
mix_in AS (
  SELECT ord, line, 0 AS lst, CAST(r AS DOUBLE) AS lpos FROM srt WHERE r > n // 2
  UNION ALL
  SELECT ord, line, 1 AS lst, CAST(ord AS DOUBLE) AS lpos FROM sp WHERE NOT is_primary),
mixed AS (
  SELECT ord, line, sum(-ln({_u('merge', 'ord')} + 1.0 / 4294967296.0))
           OVER (PARTITION BY lst ORDER BY lpos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k
  FROM mix_in),
fin AS (
  SELECT ord, line, 0 AS sec, CAST(r AS DOUBLE) AS k FROM srt WHERE r <= n // 2
  UNION ALL SELECT ord, line, 1, k FROM mixed
  UNION ALL SELECT ord, line, 2, CAST(ord AS DOUBLE) FROM sp
            WHERE is_primary AND NOT (brand <> '' AND score IS NOT NULL)),
pubd AS (
  SELECT row_number() OVER (ORDER BY sec, k, ord) AS position, line AS l0,
         CASE WHEN starts_with(line, 'REVIEW_') THEN line
              ELSE rtrim(regexp_replace(line, 'https?://\\S+', '', 'g')) END AS l1
  FROM fin),
pubd2 AS (SELECT *, regexp_replace(l1, '\\.{{10}}\\d{{2}}-\\d{{2}}', '', 'g') AS l2 FROM pubd),
pubd3 AS (SELECT *, regexp_replace(l2, '[\\x{{1F000}}-\\x{{1FFFF}}\\x{{2600}}-\\x{{27BF}}\\x{{FE00}}-\\x{{FE0F}}\\x{{200D}}]+', '', 'g') AS line FROM pubd2)
"""

ORACLE.update({
    "e5_classify": _with(BASE, REPORT, PUBLISH) + "\nSELECT ord AS line_no, reason FROM cls",
    "e5_published": _with(BASE, REPORT, PUBLISH) + "\nSELECT position, line FROM pubd3",
    "a6_brand_avg_positions": _with(BASE, PUBLISH) + "\nSELECT brand, round(avg_pos, 6) AS avg_pos FROM avgpos",
    "a7_filter_metrics": _with(BASE, REPORT, PUBLISH) + """
SELECT 'dropped_' || r AS metric, CAST(count(reason) AS BIGINT) AS value
FROM (SELECT unnest(['unknown', 'ignored', 'short_code', 'missing_code', 'recent']) AS r) LEFT JOIN cls ON reason = r GROUP BY r
UNION ALL SELECT 'input_lines', CAST(count(*) AS BIGINT) FROM cls
UNION ALL SELECT 'training_batches', CAST(count(DISTINCT batch_no) AS BIGINT) FROM hist
UNION ALL SELECT 'stripped_old_repost', CAST(count_if(stripped) AS BIGINT) FROM r3b
UNION ALL SELECT 'cleaned_new_company', CAST(count_if(cleaned) AS BIGINT) FROM r3b
UNION ALL SELECT 'defaulted_discount', CAST(count_if(defaulted) AS BIGINT) FROM r3b
UNION ALL SELECT 'marked_high', CAST(count_if(marked) AS BIGINT) FROM r3b
UNION ALL SELECT 'multi_groups_kept', CAST(count_if(is_multi) AS BIGINT) FROM kept
UNION ALL SELECT 'dropped_multi_dup', CAST((SELECT count(*) FROM m WHERE is_multi AND url IS NOT NULL)
                                       - (SELECT count(*) FROM m_win WHERE is_multi) AS BIGINT)
UNION ALL SELECT 'record_dups_dropped', CAST((SELECT count(*) FROM kept) - (SELECT count(*) FROM surv) AS BIGINT)
UNION ALL SELECT 'urls_stripped', CAST(count_if(l1 <> l0) AS BIGINT) FROM pubd3
UNION ALL SELECT 'prev_dates_stripped', CAST(count_if(l2 <> l1) AS BIGINT) FROM pubd3
UNION ALL SELECT 'emojis_stripped', CAST(count_if(line <> l2) AS BIGINT) FROM pubd3
UNION ALL SELECT 'output_lines', CAST(count(*) AS BIGINT) FROM pubd3""",
})

# ------------------------------------------------- influencer discovery ---

_DBRANDS = ", ".join(f"'{b}'" for b in D.DISCOVERY_BRANDS)
DISCOVERY = f"""
d_posts AS (SELECT o.o_orderkey, o.o_orderdate, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
d_users AS (
  SELECT dp.c_name AS username, list_sort(list(DISTINCT p.p_brand)) AS brands
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN d_posts dp ON l.l_orderkey = dp.o_orderkey
  WHERE p.p_brand IN ({_DBRANDS}) GROUP BY dp.c_name HAVING count(DISTINCT p.p_brand) >= 2),
d_known AS (SELECT DISTINCT c_name FROM d_posts WHERE o_orderdate >= {_ts(D.KNOWN_SINCE)}),
d_flag AS (
  SELECT u.username, u.brands, k.c_name IS NOT NULL AS known
  FROM d_users u LEFT JOIN d_known k ON u.username = k.c_name)
"""

ORACLE.update({
    "e6_user_brands": _with(DISCOVERY) + """
SELECT username, array_to_string(brands, ', ') AS brand_list, known FROM d_flag""",
    "a5_discovery_summary": _with(DISCOVERY) + """
SELECT count(*) AS total, CAST(count_if(known) AS BIGINT) AS in_db, CAST(count_if(NOT known) AS BIGINT) AS not_in_db,
       CASE WHEN count(*) > 0 THEN round(count_if(NOT known) * 100.0 / count(*), 2) ELSE 0.0 END AS percent_not_in_db
FROM d_flag""",
    "o6_sample_new_users": _with(DISCOVERY) + f"""
SELECT username, 'https://www.instagram.com/' || username AS url FROM d_flag WHERE NOT known
ORDER BY md5('{D.SEED}:' || username), username
LIMIT (SELECT count(*) // 10 FROM customer)""",
})

# --------------------------------------------------- name resolution (E3) -

NAMES = f"""
a1 AS (SELECT DISTINCT e_webshop AS name FROM ent JOIN cap ON ent.l_orderkey = cap.id
       WHERE cap.analysis_kind = 'list' AND cap.inserted_at > {_ts(D.REPORT_CUTOFF)} AND cap.ai_canonical IS NULL
         AND e_webshop IS NOT NULL AND e_webshop <> ''),
spell AS (
  SELECT name FROM a1
  UNION SELECT n_name FROM nation
  UNION SELECT n_name || 'NL' FROM nation
  UNION SELECT substr(n_name, 2) FROM nation
  UNION SELECT replace(n_name, 'E', 'A') FROM nation
  UNION SELECT s_name FROM supplier),
keyset AS (
  SELECT DISTINCT trim(regexp_replace(trim(split_part(line, ',', 1)), '\\s*\\(.*?\\)', '', 'g')) AS key FROM pub
  UNION SELECT unnest(regexp_extract_all(props, '["'']([^"'']+)["'']\\s*:', 1)) FROM events
  UNION SELECT lower(n_name) FROM nation
  UNION SELECT lower(r_name) FROM region)
"""


def _resolve_sql(spell: str) -> str:
    """Brute force over all (spelling, key) pairs: fine for the oracle's
    small inputs."""
    return f"""
(SELECT name, coalesce(key, 'UNKNOWN') AS canonical, coalesce(score, 0) AS score FROM (
  SELECT s.name, b.key, b.score FROM (SELECT DISTINCT name FROM {spell}) s
  LEFT JOIN (
    SELECT name, key, score FROM (
      SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, dist, key) AS rn FROM (
        SELECT name, key,
               CASE WHEN n = kn THEN 3
                    WHEN (starts_with(n, kn) OR starts_with(kn, n)) AND least(length(n), length(kn)) >= 4 THEN 2
                    WHEN 5 * levenshtein(n, kn) <= greatest(length(n), length(kn)) THEN 1 END AS score,
               levenshtein(n, kn) / greatest(length(n), length(kn)) AS dist
        FROM (SELECT name, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS n FROM (SELECT DISTINCT name FROM {spell}))
        CROSS JOIN (SELECT key, regexp_replace(lower(key), '[^a-z0-9]', '', 'g') AS kn FROM keyset)
        WHERE n <> '' AND kn <> '') WHERE score IS NOT NULL) WHERE rn = 1) b ON s.name = b.name))"""


CANON = f"""
mapping AS (SELECT *, row_number() OVER (ORDER BY name) AS map_ord FROM {_resolve_sql('a1')}),
upd AS (
  SELECT cap.id, arg_min(m.canonical, m.map_ord) AS ai_canonical
  FROM cap JOIN ent ON ent.l_orderkey = cap.id JOIN mapping m ON m.name = ent.e_webshop
  WHERE cap.analysis_kind = 'list' AND cap.inserted_at >= {_ts(D.REPORT_CUTOFF)} AND cap.ai_canonical IS NULL
  GROUP BY cap.id)
"""

ORACLE.update({
    "j6_name_resolution": _with(BASE, NAMES) + f"\nSELECT * FROM {_resolve_sql('spell')}",
    "j3_canonical_attach": _with(BASE, NAMES, CANON) + "\nSELECT id, ai_canonical FROM upd",
    "a10_rows_per_canonical": _with(BASE, NAMES, CANON) + """
SELECT ai_canonical, count(*) AS updated FROM upd GROUP BY ai_canonical""",
})


# ------------------------------------------------------- more listings ----

def _sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _prompt_sql() -> str:
    from ..functions.text import EXTRACTION_PROMPT
    return _sql_str(EXTRACTION_PROMPT)


ORACLE.update({
    "a9_posts_per_user": _with(POSTS) + """
SELECT influencer_name, post_url, ord,
       row_number() OVER (PARTITION BY influencer_name ORDER BY ord) AS pos_in_user
FROM posts""",
    "p16_keyword_scan": _with(POSTS) + f"""
SELECT row_number() OVER (ORDER BY post_date DESC, ord) AS item_no, count(*) OVER () AS item_total,
       influencer_name, post_url, ord
FROM posts WHERE {_keyword_sql('caption')}""",
    "f23_prompts": _with(POSTS) + f"""
SELECT ord, {_prompt_sql()} || coalesce(caption, '') AS prompt FROM posts""",
})


# ------------------------------------------------ analysis attach (E2) ----

def _code_sql(expr: str) -> str:
    from ..functions.extract import CODE_PATTERN
    pat = _sql_str(CODE_PATTERN)
    return (f"len(list_filter(regexp_extract_all({expr}, {pat}, 1), "
            f"lambda c: regexp_matches(c, '[0-9]') OR c = upper(c)))")


ORACLE.update({
    # the benchmark texts hold no code cue words, so every extraction is
    # '[]'; a caption with a code would show up as a NULL mismatch here
    "j2_analysis_attach": _with(POSTS) + f"""
SELECT p.ord AS id, k.ai_analysis, k.ai_analysis IS NOT NULL AS analysed
FROM posts p LEFT JOIN (
  SELECT DISTINCT platform, post_url, caption AS ck,
         CASE WHEN {_code_sql('caption')} = 0 THEN '[]' END AS ai_analysis
  FROM posts WHERE {_keyword_sql('caption')}) k
  ON p.platform = k.platform AND p.post_url = k.post_url AND p.caption = k.ck""",
})
