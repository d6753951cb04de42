import duckdb

import __spark_entry__ as E
from promolens.plans.driver import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["platform", "line", "first_inserted_at", "first_id", "first_pos", "line_no"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_fast_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ["f1_normalize_captions", "w1_archive_records", "s13_known_discounts", "e6_user_brands",
                 "a6_brand_avg_positions"]:
        df = E.queries()[name](spark, SF)
        cols = sorted(df.columns)
        a = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
        cur = con.execute(E.oracle_sql()[name])
        dcols = [d[0] for d in cur.description]
        assert sorted(dcols) == cols, name
        idx = [dcols.index(c) for c in cols]
        b = sorted(tuple(str(r[i]) for i in idx) for r in cur.fetchall())
        assert a == b, name


def test_entry_from_another_directory_with_a_plain_session(tmp_path):
    """Workers must not need the package on their path (functions ship by value)."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(repo, '__spark_entry__.py')!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
print("ROWS", m.entry(spark).count(), len(m.queries()["f1_normalize_captions"](spark, {SF!r}).collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("ROWS")]
    assert line, out.stderr[-2000:]
    rows, docs = map(int, line[0].split()[1:])
    assert rows > 0 and docs == 200
