"""DuckDB SQL for ``stored_queries.py``: the same results, without stored tables."""

from __future__ import annotations

from .oracle import POSTS, _with
from .oracle_sources import LINES, ORACLE, RECORDS

CODED = """
coded AS (
  SELECT ord, platform, post_url, x1.caption, x1.analysis FROM posts JOIN (
    SELECT doc_id, k, CASE k
        WHEN 0 THEN 'use code AAA' || n || ' for ' || p || '% at @shop.a and code BBB' || n || ' for ' || n || '% at @shop_b.'
        WHEN 1 THEN 'My code is LOTTE' || n || ' enjoy'
        WHEN 2 THEN 'korting met KIM7, ' || p || '% off'
        WHEN 3 THEN p || ' % off at @store with kortingscode: SAVE and code great'
        WHEN 4 THEN 'coupon "X' || n || 'Y" saves €' || p || ',50 at 1000% fun, code X' || n || 'Y'
        ELSE 'no discount, encode 5 things' END AS caption,
      CASE k
        WHEN 0 THEN '[{"code":"AAA' || n || '","percentage":' || p || ',"webshop":"shop.a"},{"code":"BBB'
              || n || '","percentage":' || n || ',"webshop":"shop_b"}]'
        WHEN 1 THEN '[{"code":"LOTTE' || n || '","percentage":' || n || ',"webshop":null}]'
        WHEN 2 THEN '[{"code":"KIM7","percentage":' || p || ',"webshop":null}]'
        WHEN 3 THEN '[{"code":"SAVE","percentage":' || p || ',"webshop":"store"}]'
        WHEN 4 THEN '[{"code":"X' || n || 'Y","percentage":"€' || p || ',50","webshop":null}]'
        ELSE '[]' END AS analysis
    FROM (SELECT doc_id, doc_id % 6 AS k, CAST(doc_id % 90 + 10 AS VARCHAR) AS n,
                 CAST(n_chars % 60 + 1 AS VARCHAR) AS p FROM documents)) x1 ON posts.ord = x1.doc_id),
stored AS (
  SELECT platform, post_url, caption, any_value(analysis) AS ai_analysis,
         CASE WHEN bool_or(ord % 3 = 0) THEN DATE '2025-03-01' ELSE DATE '2025-03-02' END AS inserted_on
  FROM coded GROUP BY platform, post_url, caption)"""

ORACLE.update({
    "x2_model_output": """
WITH a AS (SELECT doc_id, doc_id % 7 AS k, CAST(doc_id AS VARCHAR) AS n FROM documents)
SELECT doc_id, CASE k WHEN 2 THEN '[{"code":null,"webshop":"café ünï €' || n || '"}]' WHEN 4 THEN '[]'
                      WHEN 6 THEN '{"a":[' || n || ',true],"b":1.5}' END AS analysis, k IN (2, 4, 6) AS analysed
FROM a""",
    "j2_coded_attach": _with(POSTS, CODED) + """
, u AS (SELECT DISTINCT platform, post_url, caption, analysis FROM coded WHERE ord % 2 = 0)
SELECT c.ord AS id, u.analysis AS ai_analysis, u.analysis IS NOT NULL AS analysed
FROM coded c LEFT JOIN u ON u.platform = c.platform AND u.post_url = c.post_url AND u.caption = c.caption""",
    "e8_two_days": _with(POSTS, CODED) + """
SELECT platform, post_url, caption, inserted_on, ai_analysis, inserted_on AS analysed_on FROM stored""",
    "e8_archive": _with(POSTS, CODED) + "\nSELECT platform, post_url, caption FROM stored",
    "s12_stored_days": _with(POSTS, CODED) + """
SELECT post_url, caption, ai_analysis FROM stored
WHERE platform = 'instagram' AND inserted_on = DATE '2025-03-02'""",
    "s9_run_posts": _with(RECORDS) + """
, ok AS (
  SELECT conv_id AS run_conv, conv_id % 5 = 2 OR conv_id % 7 = 3 AS lost,
         row_number() OVER (ORDER BY conv_id % 28 DESC, conv_id) AS run_rank
  FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 4 <> 1 AND conv_id % 5 <> 2)
SELECT CAST(run_rank AS INTEGER) AS run_rank, 'instagram' AS platform,
       CASE turn % 5 WHEN 0 THEN 'o' || CAST(turn AS VARCHAR) ELSE usr END AS influencer_name,
       text AS caption, url AS post_url, stamp AS post_date
FROM ok JOIN rec ON rec.conv_id = ok.run_conv WHERE NOT lost AND turn % 5 IN (0, 1, 3)""",
    "s8_mentions": _with(RECORDS) + """
SELECT 'instagram' AS platform, CASE WHEN turn % 5 = 3 THEN usr END AS influencer_name, text AS caption,
       url AS post_url, stamp AS post_date FROM rec WHERE turn % 5 IN (1, 3)""",
    "s18_bracket_batches": _with(LINES) + """
, br AS (SELECT file, pos, CASE WHEN pos % 13 = 3 THEN ' [ ' WHEN pos % 11 = 10 THEN line || ' ],' ELSE line END AS line FROM ln),
st AS (SELECT *, max(contains(line, '[')) OVER (PARTITION BY file ORDER BY pos) AS started FROM br),
cl AS (SELECT file, pos, line, CASE WHEN trim(line) = '' OR contains(line, ']') THEN 1 ELSE 0 END AS b
       FROM st WHERE started AND NOT contains(line, '[')),
gr AS (SELECT *, sum(b) OVER (PARTITION BY file ORDER BY pos) AS gg FROM cl)
SELECT file, CAST(dense_rank() OVER (PARTITION BY file ORDER BY gg) - 1 AS INTEGER) AS batch_no, pos, trim(line) AS line
FROM gr WHERE b = 0""",
    "k5_sorted_names": "WITH a AS (SELECT name FROM (" + ORACLE["a2_known_names"] + """)
  UNION SELECT c_name FROM customer)
SELECT row_number() OVER (ORDER BY name) AS position, name AS line FROM a""",
    "k6_seed_list": "WITH s AS (SELECT url FROM (" + ORACLE["o6_sample_new_users"] + """))
SELECT url AS value FROM s UNION ALL SELECT 'https://old/' || s_name FROM supplier""",
    "k7_latest_snapshot": _with(RECORDS) + """
SELECT CASE WHEN turn % 5 IN (1, 3) THEN url END AS url, CASE WHEN turn % 5 IN (1, 3) THEN text END AS caption,
       CASE WHEN turn % 5 IN (0, 1) THEN usr END AS username
FROM rec WHERE conv_id % 2 = 1 AND turn % 5 <> 4""",
})
