"""Versions of the caption table: a write that stops half-way is never seen."""
import datetime as dt

import pytest

from promolens import sinks
from promolens.sources import versions
from promolens.sources.tables import CAPTION_PARTITIONS, CAPTION_SCHEMA, caption_table
from promolens.sources.versions import commit, newest, read_version, write_folders

DAYS = [dt.datetime(2025, 5, d, 9) for d in (1, 2, 3)]


def filled(spark, path):
    for d in DAYS:
        rows = spark.createDataFrame(
            [("instagram", "u", f"code X{d.day}", f"p{i}", "2025-01-01", i) for i in range(4)],
            "platform string, influencer_name string, caption string, post_url string, post_date string, ord int")
        sinks.insert_captions(spark, rows, path, d)


def updates(spark, ids, name):
    return spark.createDataFrame([(i, name) for i in ids], "id long, ai_canonical string")


def seen(spark, path):
    return {r.id: r.ai_canonical for r in caption_table(spark, path).collect()}


def test_a_run_that_stops_between_days_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "captions")
    filled(spark, path)
    before = seen(spark, path)
    assert sorted(before) == list(range(1, 13)) and newest(spark, path)[0] == 2
    write = versions.write_folders

    def stops(rows, path, partitions):
        write(rows.where("inserted_on < '2025-05-02'"), path, partitions)  # the first day is on disk
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "write_folders", stops)
    with pytest.raises(KeyboardInterrupt):
        sinks.update_canonical(spark, path, updates(spark, range(1, 13), "shop"))
    assert seen(spark, path) == before
    monkeypatch.setattr(versions, "write_folders", write)
    sinks.update_canonical(spark, path, updates(spark, (1, 2, 9), "shop"))
    assert seen(spark, path) == {i: "shop" if i in (1, 2, 9) else None for i in range(1, 13)}
    number, folders = newest(spark, path)
    assert number == 3 and len(folders) == 3
    assert all((tmp_path / "captions" / f).is_dir() for f in folders)


def test_only_touched_days_are_written_anew(spark, tmp_path):
    path = str(tmp_path / "captions")
    filled(spark, path)
    _, old = newest(spark, path)
    sinks.update_canonical(spark, path, updates(spark, [5], "shop"))  # day two
    _, new = newest(spark, path)
    assert len(set(old) & set(new)) == 2 and [f.split("/")[1] for f in set(new) - set(old)] == ["inserted_on=2025-05-02"]
    sinks.update_canonical(spark, path, updates(spark, [99], "nobody"))
    assert newest(spark, path)[1] == new


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "captions")
    filled(spark, path)
    early = caption_table(spark, path)
    sinks.update_canonical(spark, path, updates(spark, range(1, 13), "shop"))
    assert {r.ai_canonical for r in early.collect()} == {None}
    assert set(seen(spark, path).values()) == {"shop"}


def test_the_slower_writer_is_told(spark, tmp_path):
    path = str(tmp_path / "captions")
    filled(spark, path)
    number, folders = newest(spark, path)
    commit(spark, path, number, folders[:1])
    with pytest.raises(versions.Outrun):
        commit(spark, path, number, folders)
    assert newest(spark, path) == (number + 1, folders[:1])


def test_an_unfinished_manifest_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "captions")
    filled(spark, path)
    number, folders = newest(spark, path)
    (tmp_path / "captions" / "_manifest" / f"{number + 1:012d}").write_text("platform=instagram/ins")
    assert newest(spark, path) == (number, folders)
    more = write_folders(read_version(spark, path, CAPTION_SCHEMA).limit(1), path, CAPTION_PARTITIONS)
    assert commit(spark, path, number, folders + more) == number + 2
    assert caption_table(spark, path).count() == 13


def test_a_table_without_a_version_is_empty(spark, tmp_path):
    assert caption_table(spark, str(tmp_path / "none")).collect() == []
