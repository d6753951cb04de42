"""Plan checks: filters reach the scan, Python appears only for NFKD."""

import datetime as dt

from promolens.operators import filters
from promolens.plans import driver as D
from promolens.plans import queries as Q

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cutoff_filters_are_pushed_to_parquet(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").withColumnRenamed("o_orderdate", "inserted_at") \
        .withColumnRenamed("o_orderkey", "id")
    day = filters.records_for_date(orders.withColumn("post_date", orders.inserted_at), dt.date(1998, 3, 14))
    p = plan(day)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    since = filters.records_since(orders, dt.datetime(2000, 1, 1))
    assert "GreaterThan(o_orderdate" in plan(since)


def test_report_and_publish_stay_in_the_jvm(spark):
    known = Q.disc.known_discounts(D.published_lines(spark, SF))
    rep = Q.report.report_lines(Q._report_input(spark, SF), known, numbered=False)
    p = plan(rep)
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_normalisation_is_the_only_python_step(spark):
    p = plan(Q.QUERIES["k2_keyword_records"](spark, SF))
    assert p.count("ArrowEvalPython") == 1
    assert "BatchEvalPython" not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(Q.QUERIES["f1_normalize_captions"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_no_query_pairs_all_rows(spark):
    """No registered query plans a cross join or a row-at-a-time Python UDF."""
    from promolens.plans.source_queries import QUERIES
    for name, q in QUERIES.items():
        p = plan(q(spark, SF))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in p, (name, bad)


def test_dump_trees_are_scanned_and_parsed_once(spark, tmp_path):
    from promolens.sources import posts as P
    (tmp_path / "a.json").write_text("[]")
    p = plan(P.json_tree_posts(spark, str(tmp_path)))
    assert p.count("FileScan text") == 1 and p.count("from_json") <= 1
