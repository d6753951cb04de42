import json

from promolens.streaming.archive_stream import start_archive_stream


def test_stream_archives_new_files_once(spark, tmp_path):
    src = tmp_path / "jsons"
    (src / "insta").mkdir(parents=True)
    (src / "tiktok").mkdir(parents=True)
    (src / "insta" / "a.json").write_text(json.dumps([{"url": "u1", "caption": "Hi  there", "ownerUsername": "a"}]))
    (src / "tiktok" / "b.json").write_text(json.dumps([{"text": "t", "createTimeISO": "2025-01-01T00:00:00", "webVideoUrl": "v1"}]))
    archive = str(tmp_path / "archive")
    q = start_archive_stream(spark, str(src), archive, name=f"t{tmp_path.name}", available_now=True)
    q.awaitTermination(120)
    first = sorted((r.platform, r.post_url, r.caption) for r in spark.read.parquet(archive).collect())
    assert first == [("instagram", "u1", "Hi there"), ("tiktok", "v1", "t")]
    # a new file repeating a post and adding one
    (src / "insta" / "c.json").write_text(json.dumps([{"url": "u1", "caption": "Hi there"}, {"url": "u2", "caption": ""}]))
    q = start_archive_stream(spark, str(src), archive, name=f"t{tmp_path.name}", available_now=True)
    q.awaitTermination(120)
    second = sorted((r.platform, r.post_url) for r in spark.read.parquet(archive).collect())
    assert second == [("instagram", "u1"), ("instagram", "u2"), ("tiktok", "v1")]
