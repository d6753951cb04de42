"""Scans in segments: one long file gives the same as many short windows."""
import random

import pytest

from promolens.sources import discounts as disc
from promolens.sources import posts as P


def batches(lines, brackets):
    """Batches of one file, line by line."""
    out, batch, number, opened = [], [], 0, not brackets
    for pos, line in enumerate(lines):
        if brackets and "[" in line:
            opened = True
            continue
        if not opened:
            continue
        if line.strip() == "" or brackets and "]" in line:
            number, batch = number + bool(batch), []
        else:
            batch.append(line)
            out.append((number, pos, line.strip()))
    return out


@pytest.mark.parametrize("brackets", [False, True])
def test_batches_do_not_depend_on_the_segments(spark, brackets):
    rng = random.Random(7)
    for share in (0.05, 0.5, 0.95):
        files = {f: [rng.choice(["", " ", "[", "x ]"]) if rng.random() < share else f" l{i} " for i in range(60)]
                 for f in ("a", "b")}
        files["c"] = [""] * 9
        rows = spark.createDataFrame([(f, i, x) for f, xs in files.items() for i, x in enumerate(xs)],
                                     "file string, pos long, line string")
        want = sorted((f, *r) for f, xs in files.items() for r in batches(xs, brackets))
        for n in (1, 4, 1000):
            found = disc.batches_from_lines(rows, brackets, n).collect()
            assert sorted((r.file, r.batch_no, r.pos, r.line) for r in found) == want


def test_sections_do_not_depend_on_the_segments(spark):
    lines = ["x", "Big:", "a", "", "b", "small:", "c", "other:", "d", "BIG:", "e", "f"]
    rows = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, pos long, line string")
    for n in (1, 2, 5, 100):
        assert sorted(r.username for r in P.section_names(rows, "big", n).collect()) == ["a", "b", "e", "f"]


def test_one_long_file_is_read_by_many_tasks(spark, tmp_path):
    lines = [f"line {i}" if i % 7 else "" for i in range(60_000)]
    lines[5] = "one two"
    (tmp_path / "list.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = disc.read_lines(spark, str(tmp_path)).collect()
        ranges = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = "\n".join(lines).splitlines()
    assert ranges > 5 and [r.line for r in sorted(found, key=lambda r: r.pos)] == want
    assert [r.pos for r in sorted(found, key=lambda r: r.pos)] == list(range(len(want)))
