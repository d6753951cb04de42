"""DuckDB SQL for ``source_queries.py``: the same inputs, without files, JSON
or line parsing."""

from __future__ import annotations

from . import driver as D
from .oracle import BASE, CANON, NAMES, ORACLE, POSTS, _ts, _with

# one row per record of a readable dump file
RECORDS = """
rec AS (
  SELECT conv_id, turn, text, role, lpad(CAST(conv_id AS VARCHAR), 12, '0') AS name,
         'u' || CAST(conv_id % 50 AS VARCHAR) AS usr,
         'https://p/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS url,
         '2025-01-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:0' || CAST(turn % 10 AS VARCHAR) AS stamp,
         CASE WHEN conv_id % 3 = 0 THEN '/dump/tiktok/' ELSE '/dump/instagram/' END AS folder
  FROM conversations WHERE conv_id % 11 <> 5)"""

LINES = """
ln AS (
  SELECT conv_id AS file, turn * 2 + k AS pos, CASE k WHEN 0 THEN
           CASE WHEN turn = 0 THEN upper(role) || ':' WHEN turn % 3 = 2 THEN '  '
                ELSE ' Brand' || CAST(length(text) % 7 AS VARCHAR) || ' (x), A, 10 ' END
         ELSE CASE WHEN turn % 4 = 1 THEN '' ELSE 'brand' || CAST(length(text) % 5 AS VARCHAR) || ', B, 5' END END AS line
  FROM conversations, (SELECT unnest([0, 1]) AS k)),
grp AS (
  SELECT *, sum(CASE WHEN trim(line) = '' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY pos) AS g FROM ln),
bat AS (
  SELECT file, CAST(dense_rank() OVER (PARTITION BY file ORDER BY g) - 1 AS INTEGER) AS batch_no, pos, trim(line) AS line
  FROM grp WHERE trim(line) <> '')"""

ORACLE.update({
    "s7_tree_posts": _with(RECORDS) + """
SELECT 'instagram' AS platform, CASE turn % 5 WHEN 0 THEN 'o' || CAST(turn AS VARCHAR) ELSE usr END AS influencer_name,
       text AS caption, url AS post_url, stamp AS post_date, CAST(turn AS INTEGER) AS pos, 0 AS i
FROM rec WHERE folder = '/dump/instagram/' AND turn % 5 IN (0, 1, 3)
UNION ALL
SELECT 'tiktok', usr, text, url, stamp, CAST(turn AS INTEGER), 0 FROM rec WHERE folder = '/dump/tiktok/' AND turn % 5 = 2""",
    "s7_unreadable": """
SELECT DISTINCT CASE WHEN conv_id % 3 = 0 THEN '/dump/tiktok/' ELSE '/dump/instagram/' END
       || lpad(CAST(conv_id AS VARCHAR), 12, '0') AS file
FROM conversations WHERE conv_id % 11 = 5""",
    # single posts name a user too, and have no list: an empty one
    "s1_profile_posts": _with(RECORDS) + """
SELECT usr AS username, text AS caption, url, stamp AS timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY usr ORDER BY folder || name DESC, turn DESC) AS rn
  FROM rec WHERE turn % 5 IN (0, 1)) WHERE rn = 1 AND turn % 5 = 0
UNION ALL
SELECT usr, 'no url', '', NULL FROM (
  SELECT *, row_number() OVER (PARTITION BY usr ORDER BY folder || name DESC, turn DESC) AS rn
  FROM rec WHERE turn % 5 IN (0, 1)) WHERE rn = 1 AND turn % 5 = 0""",
    "s2_merged_mentions": _with(RECORDS) + """
SELECT usr AS username, text AS caption, url, stamp AS timestamp, role AS mentions,
       CAST(conv_id % 2 AS INTEGER) AS src, folder || name AS file FROM rec WHERE turn % 5 = 3""",
    "s3_tiktok_posts": _with(RECORDS) + """
SELECT usr AS username, text AS caption, url, stamp AS timestamp FROM rec WHERE turn % 5 = 2""",
    "s4_hashtag_posts": _with(RECORDS) + """
SELECT CASE WHEN turn % 5 = 3 THEN usr END AS username, text AS caption, url, stamp AS timestamp
FROM rec WHERE turn % 5 IN (1, 3)""",
    "s17_batches": _with(LINES) + "\nSELECT file, batch_no, pos, line FROM bat",
    "u3_training_brands": _with(LINES) + """
, pick AS (SELECT CAST(file % 2 AS INTEGER) AS source, *, count(*) OVER (PARTITION BY file, batch_no) AS n FROM bat
           WHERE file % 2 = 1 OR batch_no >= 1)
SELECT source, file, batch_no, pos, lower(trim(split_part(split_part(line, ',', 1), '(', 1))) AS brand FROM pick WHERE n >= 2""",
    "s16_report_block": """
WITH l AS (
  SELECT conv_id % 9 AS file, conv_id * 100 + turn AS pos, turn, text FROM conversations),
n AS (SELECT * FROM l WHERE file = (SELECT max(file) FROM l)),
b AS (SELECT min(pos) AS a FROM n WHERE turn = 0),
e AS (SELECT min(pos) AS z FROM n, b WHERE turn % 7 = 6 AND pos > a)
SELECT pos, '"' || regexp_replace(text, '[\\r\\n]', ' ', 'g') || '"' AS line FROM n, b, e
WHERE pos > a AND (z IS NULL OR pos < z) AND turn <> 0 AND turn % 7 <> 6 AND turn % 5 <> 4""",
    "j1_code_lookup": """
WITH j AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id, l_linenumber % 3 AS k, lower(p_brand) AS b,
                  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT DISTINCT CASE k WHEN 0 THEN '..."' || b || ', N/A, 1, x, 06-30",..........09-01'
                       WHEN 1 THEN '..."' || b || ', None, 1, x, 06-30",..........08-08'
                       ELSE CASE WHEN q = '7' THEN '..."' || b || ', Q7, 1, x, 06-30",..........07-07'
                                 ELSE '"' || b || ', Q' || q || ', 1, x, 06-30",' END END AS line
FROM j""",
    "x1_extract": """
WITH c AS (SELECT doc_id, doc_id % 6 AS k, CAST(doc_id % 90 + 10 AS VARCHAR) AS n, CAST(n_chars % 60 + 1 AS VARCHAR) AS p
           FROM documents)
SELECT doc_id, CASE k
  WHEN 0 THEN '[{"webshop":"shop.a","code":"AAA' || n || '","percentage":' || p || '},{"webshop":"shop_b","code":"BBB'
              || n || '","percentage":' || n || '}]'
  WHEN 1 THEN '[{"webshop":null,"code":"LOTTE' || n || '","percentage":' || n || '}]'
  WHEN 2 THEN '[{"webshop":null,"code":"KIM7","percentage":' || p || '}]'
  WHEN 3 THEN '[{"webshop":"store","code":"SAVE","percentage":' || p || '}]'
  WHEN 4 THEN '[{"webshop":null,"code":"X' || n || 'Y","percentage":"€' || p || ',50"}]'
  ELSE '[]' END AS analysis
FROM c""",
    "a11_new_rows": _with(POSTS) + """
, f AS (SELECT platform, post_url, caption, min(ord % 7 + 1) AS run FROM posts GROUP BY ALL),
r AS (SELECT n_nationkey + 1 AS run_rank FROM nation),
a AS (SELECT CAST(run_rank AS INTEGER) AS run_rank, count(run) AS added FROM r LEFT JOIN f ON run = run_rank GROUP BY 1)
SELECT run_rank, added, CAST(sum(added) OVER (ORDER BY run_rank) AS BIGINT) AS running_unique FROM a""",
})

ORACLE.update({
    "k1_archive_insert": _with(POSTS) + """
SELECT platform, influencer_name, caption, post_url FROM archive a
WHERE NOT EXISTS (SELECT 1 FROM posts s WHERE s.influencer_name = 'src0' AND s.platform = a.platform
                  AND s.post_url = a.post_url AND s.caption = a.caption)""",
    "k2_caption_insert": _with(POSTS) + """
SELECT (SELECT max(ord) FROM posts WHERE influencer_name = 'src0')
         + row_number() OVER (ORDER BY platform, ord) AS id, platform, influencer_name, post_url
FROM kw a WHERE NOT EXISTS (SELECT 1 FROM posts s WHERE s.influencer_name = 'src0' AND s.platform = a.platform
                            AND s.post_url = a.post_url AND s.caption = a.caption)""",
    "k4_canonical_update": _with(BASE, NAMES, CANON) + """
SELECT cap.id, cap.platform, coalesce(u.ai_canonical, cap.ai_canonical) AS ai_canonical
FROM cap LEFT JOIN upd u ON u.id = cap.id""",
    "o1_insert_order": _with(BASE) + f"""
SELECT id, row_number() OVER (ORDER BY inserted_at, id) AS place FROM cap WHERE inserted_at > {_ts(D.REPORT_CUTOFF)}""",
    "s11_sections": """
WITH l AS (SELECT event_id // 1000 AS file, event_id AS pos, event_id % 10 AS k,
                  event_type || '_' || CAST(user_id AS VARCHAR) AS v FROM events),
h AS (SELECT *, last_value(CASE WHEN k IN (0, 5) THEN k END IGNORE NULLS) OVER (PARTITION BY file ORDER BY pos) AS sec FROM l)
SELECT file, pos, v AS username FROM h WHERE k NOT IN (0, 5, 7) AND sec = 0""",
})
