import hashlib
import re
from collections import defaultdict

from llm_fixtures import awkward, empty, frame, texts
from pyspark.sql import functions as F

from promolens.llm.common import columns_of
from promolens.llm.exact_dedup import chunks_of, exact_dedup, normalised, verified_width


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return {(i, min(ids), len(ids), i == min(ids), hashlib.sha256(n.encode()).hexdigest())
            for n, ids in groups.items() for i in ids}


def test_matches_brute_force(spark):
    rows = texts()
    assert {tuple(r) for r in exact_dedup(frame(spark, rows)).collect()} == brute(rows)


def test_collisions_widen_the_identifiers(spark):
    rows = texts()
    assert {tuple(r) for r in exact_dedup(frame(spark, rows), bits=2).collect()} == brute(rows)
    chunks = columns_of(frame(spark, rows), "text").select(F.explode(chunks_of(F.coalesce("text", F.lit("")))).alias("chunk"))
    bits, _ = verified_width(chunks, 2)
    assert bits > 2


def test_chunks_rebuild_the_text(spark):
    df = columns_of(frame(spark, texts()), "text").select(normalised(F.coalesce("text", F.lit(""))).alias("t"))
    assert df.where(F.concat_ws("", chunks_of(F.col("t"), 8, 40)) != F.col("t")).isEmpty()


def test_awkward_rows_and_empty_table(spark):
    got = exact_dedup(awkward(spark)).collect()
    assert len(got) == awkward(spark).count()
    assert exact_dedup(empty(spark)).collect() == []
    nulls = [r for r in got if r.doc_id is None]
    assert {r.kept for r in nulls} == {True, False}  # "no id here" is alone, the null text is a copy of 41
