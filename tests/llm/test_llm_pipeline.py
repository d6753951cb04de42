import re

import corpus_pipeline as C
from llm_fixtures import awkward, empty, frame, texts

import __spark_entry__ as E

from promolens.llm.common import columns_of

SF = "/root/testdata/sf0.001"


def plain(df):
    """The columns of ``documents`` that the stages need, and one more."""
    return columns_of(df, "doc_id", "text", "lang", "key")


def test_registered_queries():
    names = set(E.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {
        f"op{k}" for k in range(1, 14)}
    assert [n for n, _ in C.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup",
                                        "mixing to target weights", "best-fit packing"]


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    counts = []
    for _, stage in C.STAGES[:-1]:
        schema = docs.schema
        docs = C.written(stage(spark, docs, SF))
        assert docs.columns == schema.names
        counts.append(docs.count())
    assert before > counts[0] > counts[1] >= counts[2] <= counts[3]
    assert docs.select("doc_id").distinct().count() == counts[2]  # mixing repeats rows, but loses none
    packed = C.STAGES[-1][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == counts[3]


def test_dedup_stages_match_their_contracts(spark):
    rows = texts()
    kept = {r.doc_id for r in C.exact(spark, plain(frame(spark, rows + rows[:4])), SF).collect()}
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    assert kept == {min(i for i, t in norm if t == x) for x in {t for _, t in norm}}
    assert C.exact(spark, plain(frame(spark, rows + rows[:4])), SF).count() == len(kept)
    assert C.near(spark, plain(frame(spark, rows)), SF).count() < len(rows)


def test_awkward_rows_and_empty_table(spark):
    for name, stage in C.STAGES:
        some = stage(spark, plain(awkward(spark)), SF)
        assert some.count() > 0, name
        assert stage(spark, plain(empty(spark)), SF).count() == 0, name


def test_run_matches_the_stages(spark):
    assert C.run(spark, SF).count() > 100
