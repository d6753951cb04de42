import json

from pyspark.sql import Observation

from promolens.sources import discounts as disc
from promolens.sources import logs
from promolens.sources import posts as P


def write(path, obj):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(obj if isinstance(obj, str) else json.dumps(obj), encoding="utf-8")
    return str(path)


def test_instagram_profiles(spark, tmp_path):
    f = write(tmp_path / "p" / "profiles.json", [
        {"username": "", "latestPosts": [{"caption": "x", "url": "u0"}]},
        {"username": "a", "latestPosts": None},
        {"username": "b", "latestPosts": "nope"},
        {"username": "c", "latestPosts": [{"url": "u1"}, {"caption": None, "url": "u2", "timestamp": "t"}]},
        {"username": "d"},
        {"username": "c", "latestPosts": [{"caption": "new", "url": "u3"}]},
        "not a dict",
    ])
    recs = P.read_json_records(spark, f)
    got = sorted((r.username, r.caption, r.url, r.timestamp) for r in P.instagram_profiles(recs).collect())
    assert got == [("c", "new", "u3", None)]


def test_tagged_tiktok_hashtag(spark, tmp_path):
    f = write(tmp_path / "m.json", [
        {"ownerUsername": "u", "caption": "c1", "url": "x1", "timestamp": "2025-01-02", "mentions": ["b1"]},
        {"ownerUsername": "", "caption": "c2", "url": "x2", "timestamp": "2025-01-03"},
        {"ownerUsername": "u", "caption": "c3", "url": "x3"},
        {"ownerUsername": "v", "caption": None, "url": "x4", "timestamp": "2025-01-01"},
    ])
    posts, rejects = P.tagged_posts(P.read_json_records(spark, f))
    assert sorted(r.url for r in posts.collect()) == ["x1", "x4"]
    assert rejects.count() == 1
    hashtag = [r.url for r in P.hashtag_posts(P.read_json_records(spark, f)).collect()]
    assert hashtag == ["x2", "x1", "x4"]
    t = write(tmp_path / "t.json", [
        {"authorMeta": {"name": "k"}, "text": "hi", "createTimeISO": "2025", "webVideoUrl": "v1"},
        {"authorMeta": {"name": "k"}, "error": "x"},
        {"authorMeta": None, "text": "a", "createTimeISO": "2025", "webVideoUrl": "v2"},
    ])
    recs = P.read_json_records(spark, t)
    assert [r.url for r in P.tiktok_posts(recs).collect()] == ["v1"]
    assert sorted((r.influencer_name or "", r.post_url) for r in P.extract_tiktok(recs).collect()) == [("", "v2"), ("k", "v1")]


def test_json_tree_and_generic_instagram(spark, tmp_path):
    write(tmp_path / "jsons" / "insta" / "users" / "a.json", [
        {"username": "p", "latestPosts": [{"url": "i1", "caption": "c"}, {"url": "", "caption": "skip"},
                                          {"url": "i2", "ownerUsername": "q"}]},
        {"username": "r", "url": "i3", "caption": "self"},
        {"username": "s", "url": "i4"},
    ])
    write(tmp_path / "jsons" / "tiktok" / "b.json", [{"text": "t", "createTimeISO": "x", "webVideoUrl": "t1"}])
    write(tmp_path / "jsons" / "insta" / "bad.json", "{not json")
    write(tmp_path / "jsons" / "insta" / "obj.json", {"url": "o1", "caption": "x"})
    write(tmp_path / "jsons" / "insta" / "already_loaded" / "c.json", [{"url": "ex", "caption": "x"}])
    df = P.json_tree_posts(spark, str(tmp_path / "jsons"), exclude="already_loaded")
    got = sorted((r.platform, r.influencer_name, r.post_url) for r in df.collect())
    assert got == [("instagram", "p", "i1"), ("instagram", "q", "i2"), ("instagram", "r", "i3"),
                   ("tiktok", None, "t1")]


def test_seed_and_sectioned_lists(spark, tmp_path):
    f = write(tmp_path / "urls.txt", "  a  \n\n b\n")
    assert [r.value for r in P.seed_list(spark, f).orderBy("pos").collect()] == ["a", "b"]
    s = write(tmp_path / "sections.txt", "BIG:\nx\ny\nsmall:\nz\nother:\nw\nbig:\nv\n")
    assert [r.username for r in P.sectioned_list(spark, s, "big").orderBy("pos").collect()] == ["x", "y", "v"]
    assert [r.username for r in P.sectioned_list(spark, s, "small").collect()] == ["z"]


def test_known_discounts_and_names(spark, tmp_path):
    f = write(tmp_path / "discounts.json", [
        "Zalando (11 aug), ABC, 10, x, 08-11", "zalando, abc, 20, y, 07-01", "short, x",
        "Nakd (a) shop, N1, 5, z, 06-01", 5, ""])
    lines = disc.read_json_string_array(spark, f)
    known = sorted(tuple(r) for r in disc.known_discounts(lines).select("canonical_key", "code_key", "seen_md").collect())
    assert known == [("nakd", "n1", "06-01"), ("zalando", "abc", "08-11")]
    names = sorted(r.name for r in disc.canonical_names_from_discounts(lines).collect())
    assert names == ["Nakd shop", "Zalando", "short", "zalando"]
    ts = spark.createDataFrame([("const links = { 'hm': 'x', \"Na-kd\" : 'y' };",)], "value string")
    assert sorted(r.name for r in disc.keys_from_source_text(ts).collect()) == ["Na-kd", "hm"]


def test_batches_and_log_block(spark, tmp_path):
    d = write(tmp_path / "d.json", '[\n"a, 1",\n"b, 2",\n\n"c, 3"\n]\n')
    b = disc.batches_from_lines(disc.read_lines(spark, d), bracket_rules=True)
    assert sorted((r.batch_no, r.line) for r in b.collect()) == [(0, '"a, 1",'), (0, '"b, 2",'), (1, '"c, 3"')]
    a = write(tmp_path / "a.txt", "x\ny\n\n\nz\n")
    b2 = disc.batches_from_lines(disc.read_lines(spark, a))
    assert sorted((r.batch_no, r.line) for r in b2.collect()) == [(0, "x"), (0, "y"), (1, "z")]
    write(tmp_path / "logs" / "main_pipeline_2025-01-01.log", "**PRINTING RESULTS**\nold\n")
    write(tmp_path / "logs" / "main_pipeline_2025-02-01.log",
          "before\n**PRINTING RESULTS**\n**instagram results:**\nl1\n\n  l2  \nPrinted 2 unique discount records.\n"
          "**FINISHED MAIN PIPELINE**\nafter\n")
    got = [r.line for r in logs.latest_log_lines(spark, str(tmp_path / "logs")).orderBy("ord").collect()]
    assert got == ["l1", "  l2  "]


def test_archived_mentions(spark, tmp_path):
    f = write(tmp_path / "arch" / "a.json", [{"ownerUsername": "u", "caption": "c", "url": "x1", "timestamp": "t"},
                                             {"ownerUsername": "v", "caption": "d", "url": ""},
                                             {"ownerUsername": "w", "caption": "e"}])
    seen = Observation()
    posts = P.archived_mentions(spark, str(tmp_path / "arch"), seen)
    assert [r.post_url for r in posts.collect()] == ["x1"]
    assert seen.get == {"scanned": 3, "skipped_no_url": 2}  # counted in the same pass


def test_numbered_hashtag_posts(spark):
    from promolens.operators.ingest import numbered_posts
    df = spark.createDataFrame([("a", "20% off", "2025-01-02", 1), ("b", "hello", "2025-01-03", 2),
                                ("c", "my code X", "2025-01-01", 3)],
                               "username string, caption string, post_date string, ord long")
    allp = [(r.username, r.item_no, r.item_total) for r in numbered_posts(df).orderBy("item_no").collect()]
    assert allp == [("b", 1, 3), ("a", 2, 3), ("c", 3, 3)]
    kw = [(r.username, r.item_no, r.item_total) for r in numbered_posts(df, True).orderBy("item_no").collect()]
    assert kw == [("a", 1, 2), ("c", 2, 2)]
