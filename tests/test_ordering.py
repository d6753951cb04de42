import random

import pandas as pd
import pytest
from promolens.operators.ordering import global_rank, grouped_prefix_sum


def test_global_rank_matches_sort(spark):
    rnd = random.Random(3)
    data = [(i, rnd.randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(data, "id long, k long")
    for parts in (1, 3, 8):
        got = global_rank(df, ["k", "id"], "r", num_partitions=parts).orderBy("r").collect()
        expect = sorted(data, key=lambda t: (t[1], t[0]))
        assert [(r.id, r.k) for r in got] == expect
        assert [r.r for r in got] == list(range(1, 501))


@pytest.mark.parametrize("coalesce", ["true", "false"])
@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_grouped_prefix_sum(spark, coalesce, threshold):
    rnd = random.Random(5)
    data = [(g, i, float(rnd.randint(1, 9))) for g in (0, 1) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, pos long, v double")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": coalesce,
            "spark.sql.autoBroadcastJoinThreshold": threshold,
            "spark.sql.adaptive.autoBroadcastJoinThreshold": threshold}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = grouped_prefix_sum(df, "g", ["pos"], "v", "run", num_partitions=5).toPandas()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    pdf = pd.DataFrame(data, columns=["g", "pos", "v"]).sort_values(["g", "pos"])
    pdf["run"] = pdf.groupby("g")["v"].cumsum()
    m = got.merge(pdf, on=["g", "pos"], suffixes=("", "_e"))
    assert len(m) == 6000 and (abs(m["run"] - m["run_e"]) < 1e-9).all()


def test_global_rank_total(spark):
    got = global_rank(spark.range(77), ["id"], "r", num_partitions=4, total="n").collect()
    assert {r.n for r in got} == {77} and sorted(r.r for r in got) == list(range(1, 78))
