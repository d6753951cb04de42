"""JSON lists in byte ranges: the same rows as of files read whole."""
import json
import random

from promolens.sources.posts import read_json_records


def rows_of(df):
    from pyspark.sql import functions as F
    return sorted((r.file.rsplit("/", 1)[-1], r.pos, r.t) for r in df.select("file", "pos", F.to_json("rec").alias("t")).collect())


def value(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 5)
    if kind < 3:
        return "".join(rng.choice(['a', '{', '}', '[', ']', '"', "\\", ",", "é", "\n", " "]) for _ in range(rng.randrange(12)))
    if kind < 5:
        return rng.choice([7, None, True, -1.5])
    if kind == 5:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice("abc}{"): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def test_same_rows_as_of_whole_files(spark, tmp_path):
    rng = random.Random(2)
    for i in range(30):
        data = [value(rng) for _ in range(rng.randrange(25))]
        text = json.dumps(data, ensure_ascii=i % 2 == 0, indent=rng.choice([None, 1]))
        (tmp_path / f"good{i:02}.json").write_text(rng.choice(["", "\n "]) + text + rng.choice(["", " \n"]))
    for i, bad in enumerate(['{"a":1}', '[{"a":1}', '[{"a":1},]', '[{"a":1} {"b":2}]', '[{"a":1}]]', "", "[", '[{"a":}]',
                             '"[{}]"', '[{"a":"}]', "[1 2]", '[{"a":1}] x', '[{"a":1},,{"b":2}]', '[{"a":1}', '[,{"a":1}]']):
        (tmp_path / f"bad{i:02}.json").write_text(bad)
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "scalars.json").write_text('[1,"}",null,[{"x":1}],{"y":2},3]')
    # read whole, a list is also found where more text follows it; json.loads refuses that
    want = [r for r in rows_of(read_json_records(spark, str(tmp_path))) if not r[0].startswith("bad")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")  # files lie in many ranges
    try:
        found = rows_of(read_json_records(spark, str(tmp_path), split=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(want) > 100 and found == want
    assert not any(f.startswith("bad") for f, _, _ in found)


def test_a_large_list_is_read_by_many_tasks(spark, tmp_path):
    n = 40_000
    with open(tmp_path / "big.json", "w") as f:
        f.write("[" + ",".join(json.dumps({"url": f"u{i}", "caption": "} { \\ \" [" * (i % 4)}) for i in range(n)) + "]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 17))
    try:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() >= 8
        from pyspark.sql import functions as F
        recs = read_json_records(spark, str(tmp_path), split=True)
        rows = recs.select("pos", F.try_variant_get("rec", "$.url", "string").alias("url")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.pos, r.url) for r in rows) == [(i, f"u{i}") for i in range(n)]
