import datetime as dt
import json

from promolens import sinks
from promolens.plans import jobs
from promolens.sources import posts as P


def write(path, obj):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(obj), encoding="utf-8")


def test_backfill_tree(spark, tmp_path):
    root = tmp_path / "jsons"
    write(root / "insta" / "a.json", [{"username": "p", "latestPosts": [{"url": "i1", "caption": "A  b"},
                                                                        {"url": "i1", "caption": "A b"}]}])
    write(root / "tiktok" / "b.json", [{"authorMeta": {"name": "k"}, "text": "x", "createTimeISO": "2025-01-01T00:00:00",
                                        "webVideoUrl": "t1"}])
    wh = jobs.Warehouse(archive=str(tmp_path / "archive"), captions_path=str(tmp_path / "cap"))
    a8 = {r.platform: (r.raw, r.unique_posts) for r in jobs.backfill_json_tree(spark, str(root), wh).collect()}
    assert a8 == {"instagram": (2, 1), "tiktok": (1, 1)}
    assert spark.read.parquet(wh.archive).count() == 2
    jobs.backfill_json_tree(spark, str(root), wh)            # safe to re-run
    assert spark.read.parquet(wh.archive).count() == 2


def test_manifest_runs_and_new_rows(spark, tmp_path):
    ds = tmp_path / "datasets"
    write(ds / "d1.json", [{"url": "a", "caption": "x"}, {"url": "b", "caption": "y"}])
    write(ds / "d2.json", [{"url": "a", "caption": "x"}, {"url": "c", "caption": "z"}])
    write(ds / "d3.json", [{"url": "q", "caption": "x"}])
    runs = spark.createDataFrame([
        ("r1", "SUCCEEDED", "d1", dt.datetime(2025, 1, 2)), ("r2", "SUCCEEDED", "d2", dt.datetime(2025, 1, 1)),
        ("r3", "FAILED", "d3", dt.datetime(2025, 1, 3)), ("r4", "SUCCEEDED", None, dt.datetime(2025, 1, 4))],
        "run_id string, status string, defaultDatasetId string, startedAt timestamp")
    ok = P.successful_runs(runs)
    assert [r.run_id for r in ok.orderBy("run_rank").collect()] == ["r1", "r2"]
    posts = P.run_datasets(spark, ok, str(ds), "instagram")
    a11 = [(r.run_rank, r.added, r.running_unique) for r in jobs.new_rows_per_run(posts, ok).orderBy("run_rank").collect()]
    assert a11 == [(1, 2, 2), (2, 1, 3)]
    write(ds / "d5.json", [{"url": "a", "caption": "x  "}])
    more = runs.union(spark.createDataFrame([("r0", "SUCCEEDED", "d5", dt.datetime(2024, 1, 1)),
                                             ("r9", "SUCCEEDED", "gone", dt.datetime(2023, 1, 1))], runs.schema))
    wh = jobs.Warehouse(archive=str(tmp_path / "archive"), captions_path=str(tmp_path / "cap"))
    a8, a11 = jobs.backfill_runs(spark, more, str(ds), "instagram", wh)
    assert [tuple(r) for r in a8.collect()] == [("instagram", 5, 3)]
    assert sorted(tuple(r) for r in a11.collect()) == [(1, 2, 2), (2, 1, 3), (3, 0, 3), (4, 0, 3)]
    assert spark.read.parquet(wh.archive).count() == 3
    # the limit applies before the status filter
    assert P.successful_runs(runs, max_runs=1).count() == 0


def test_text_and_json_sinks(spark, tmp_path):
    lines = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "position long, line string")
    sinks.write_lines(lines, str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(f.read_text() for f in files).splitlines() == ["a", "b", "c"]
    urls = spark.createDataFrame([("https://www.instagram.com/u1",)], "url string")
    for run in ("r1", "r1", "r2"):  # a run that is done again adds nothing twice
        sinks.append_seed_urls(urls, str(tmp_path / "seed"), str(tmp_path / "added"), run)
    assert P.seed_list(spark, str(tmp_path / "seed")).count() == 2
    assert spark.read.text(str(tmp_path / "added")).count() == 1
    assert [tuple(r) for r in sinks.read_ordered(spark, str(tmp_path / "out")).orderBy("position").collect()] == [
        (1, "a"), (2, "b"), (3, "c")]
    path = sinks.snapshot_json(spark.createDataFrame([("x",)], "a string"), str(tmp_path / "raw"), "big",
                               dt.datetime(2025, 1, 2, 3, 4, 5))
    assert path.endswith("size=big/ts=2025-01-02_03-04-05")
    assert spark.read.json(path).count() == 1


def test_newest_complete_snapshot(spark, tmp_path):
    root = str(tmp_path / "raw")
    assert sinks.latest_snapshot(spark, root, "big").collect() == []
    for day in (2, 5, 3):
        sinks.snapshot_json(spark.createDataFrame([(str(day),)], "record string"), root, "big", dt.datetime(2025, 1, day))
    (tmp_path / "raw" / "size=big" / "ts=2025-02-01_00-00-00").mkdir()  # a run that did not end
    assert [r.record for r in sinks.latest_snapshot(spark, root, "big").collect()] == ["5"]


def test_stored_days_read_their_partitions_alone(spark, tmp_path):
    from promolens.sources.tables import caption_days
    wh = jobs.Warehouse(archive=str(tmp_path / "archive"), captions_path=str(tmp_path / "cap"))
    for day in (1, 2, 3):
        posts = spark.createDataFrame([("instagram", "u", f"code X{day}", "p", "2025-01-01", day)],
                                      "platform string, influencer_name string, caption string, post_url string,"
                                      " post_date string, ord int")
        jobs.caption_ingest(spark, posts, wh, dt.datetime(2025, 5, day), ["code"])
    rows = caption_days(spark, wh.captions_path, dt.date(2025, 5, 2), dt.date(2025, 5, 2), "instagram")
    assert [r.caption for r in rows.collect()] == ["code X2"]
    assert len(rows.inputFiles()) == 3  # of the table
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(inserted_on" in plan or "PartitionFilters: [isnotnull(platform" in plan


def test_discovery_job(spark, tmp_path):
    write(tmp_path / "m" / "a.json", [
        {"ownerUsername": "u1", "mentions": ["loavies", "gutsgusto", "x"]},
        {"ownerUsername": "u2", "mentions": ["x"]},
        {"ownerUsername": "u3", "mentions": ["famousstore"]},
        {"ownerUsername": "", "mentions": ["loavies"]}])
    known = spark.createDataFrame([("u3",)], "name string")
    listing, summary, sample = jobs.influencer_discovery(spark, str(tmp_path / "m"), known, existing_seed_lines=0, seed=3)
    assert sorted(tuple(r) for r in listing.collect()) == [("u1", "gutsgusto, loavies", False), ("u3", "famousstore", True)]
    s = summary.first()
    assert (s.total, s.in_db, s.not_in_db, s.percent_not_in_db) == (2, 1, 1, 50.0)
    assert [r.url for r in sample.collect()] == ["https://www.instagram.com/u1"]
    _, _, none = jobs.influencer_discovery(spark, str(tmp_path / "m"), known, existing_seed_lines=5000, seed=3)
    assert none.count() == 0


def test_daily_run(spark, tmp_path):
    wh = jobs.Warehouse(archive=str(tmp_path / "archive"), captions_path=str(tmp_path / "cap"))
    now = dt.datetime(2025, 10, 6, 8)
    schema = "influencer_name string, caption string, post_url string, post_date string, ord long"
    sources = {
        "instagram": spark.createDataFrame([("anna", "code SUMMER20 @zalando 20%", "https://p/1", "2025-10-05T00:00:00", 1)], schema),
        "instagram_mention": spark.createDataFrame([("bob", "nothing here", "https://p/2", "2025-10-05T00:00:00", 1)], schema),
        "tiktok": spark.createDataFrame([("cat", "kortingscode CAT10 @nakd", "https://t/1", "2025-10-05T00:00:00", 1)], schema),
    }
    discounts = spark.createDataFrame([(1, "zalando, other, 5, q, 09-01")], "ord long, line string")
    lines = jobs.daily_run(spark, wh, sources, dt.date(2025, 10, 6), dt.datetime(2025, 10, 1), dt.datetime(2025, 10, 1),
                           discounts, now).orderBy("line_no").collect()
    assert [r.line for r in lines] == ['"zalando, SUMMER20, 20, anna, 10-06",    https://p/1',
                                       '"___nakd, CAT10, 10, cat_tiktok, 10-06",    https://t/1']
    assert spark.read.parquet(wh.archive).count() == 3


def test_second_daily_run_keeps_the_first_day(spark, tmp_path):
    schema = "influencer_name string, caption string, post_url string, post_date string, ord long"
    texts = spark.createDataFrame([('{"nakd": 1}',)], "value string")
    discounts = spark.createDataFrame([(1, "zalando, other, 5, q, 09-01")], "ord long, line string")
    for day, row in ((6, ("anna", "code SUMMER20 @zalando 20%", "https://p/1", "2025-10-05T00:00:00", 1)),
                     (7, ("cat", "kortingscode CAT10 @nakd", "https://p/9", "2025-10-06T00:00:00", 1))):
        wh = jobs.Warehouse(archive=str(tmp_path / "archive"), captions_path=str(tmp_path / "cap"))  # as a new process
        lines = jobs.daily_run(spark, wh, {"instagram": spark.createDataFrame([row], schema)}, dt.date(2025, 10, day),
                               dt.datetime(2025, 10, 1), dt.datetime(2025, 10, 1), discounts,
                               dt.datetime(2025, 10, day, 8), source_texts=texts).orderBy("line_no").collect()
        first_day = sorted(f.name for f in (tmp_path / "cap").rglob("inserted_on=2025-10-06/*.parquet"))
        before = first_day if day == 6 else before
    assert first_day == before  # the second day's updates rewrote the second day only
    assert [r.line for r in lines] == ['"zalando, SUMMER20, 20, anna, 10-06",    https://p/1',
                                       '"nakd, CAT10, 10, cat, 10-07",    https://p/9']
    assert all(r.ai_analysis for r in wh.captions(spark).collect())


def test_mention_backfill_and_job_sinks(spark, tmp_path):
    write(tmp_path / "m" / "a.json", [{"ownerUsername": "u", "caption": "c", "url": "x", "timestamp": "2025-01-01"},
                                      {"ownerUsername": "u", "caption": "c", "url": ""}])
    wh = jobs.Warehouse(archive=str(tmp_path / "archive"), captions_path=str(tmp_path / "cap"))
    a8, scanned = jobs.backfill_mentions(spark, str(tmp_path / "m"), wh)
    assert [tuple(r) for r in a8.collect()] == [("instagram", 1, 1)]
    assert tuple(scanned.first()) == (2, 1)
    jobs.mention_posts(spark, str(tmp_path / "m"), str(tmp_path / "m"), str(tmp_path / "raw"), dt.datetime(2025, 1, 2))
    assert spark.read.json(str(tmp_path / "raw")).count() == 4
    write(tmp_path / "d" / "a.json", [{"ownerUsername": "u1", "mentions": ["loavies"]}])
    jobs.influencer_discovery(spark, str(tmp_path / "d"), spark.createDataFrame([], "name string"), 0, 3,
                              seed_path=str(tmp_path / "seed"), log_path=str(tmp_path / "log"))
    assert P.seed_list(spark, str(tmp_path / "seed")).count() == 1


def test_lists_beyond_the_variant_limit(spark):
    from pyspark.sql import functions as F
    record = F.concat(F.lit('{"url":"u","caption":"'), F.repeat(F.lit("x"), 100_000), F.lit('"},'))
    value = F.concat(F.lit("["), F.repeat(record, 1400), F.lit('"no object",{}]'))
    raw = spark.range(1).select(F.lit("big").alias("file"), value.alias("value"))
    assert P.records_from_text(raw).count() == 1401
    few = spark.createDataFrame([("a", "[1"), ("b", ""), ("c", "{}"), ("d", "[]"), ("e", "null")],
                                "file string, value string")
    assert P.records_from_text(few).count() == 0
    assert sorted(r.file for r in P.unreadable(few).collect()) == ["a", "c", "e"]


def test_extraction_of_several_codes(spark):
    from promolens.functions.extract import extract_analysis_json
    cases = {"code AAA10 for 10% at @shopa and code BBB20 for 20% at @shopb":
             [("shopa", "AAA10", 10), ("shopb", "BBB20", 20)],
             "my code is LOTTE15": [(None, "LOTTE15", 15)],
             "korting met KIM20, 20% off": [(None, "KIM20", 20)],
             "1000% sure: code XY1": [(None, "XY1", 1000)],
             "@shop.nl has €5,50 off with code TEST": [("shop.nl", "TEST", "€5,50")],
             "no codes, encode this": [], None: []}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = [json.loads(r[0]) for r in df.select(extract_analysis_json("c")).collect()]
    assert [[(e["webshop"], e["code"], e["percentage"]) for e in g] for g in got] == list(cases.values())


def test_publication_from_log(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "main_pipeline_2025-10-06.log").write_text(
        "**PRINTING RESULTS**\n**instagram results:**\n"
        '"zal, A1, 10, anna, 10-06",    https://p/1\n"UNKNOWN, B2, 5, bob, 10-06",\n'
        "Printed 2 unique discount records.\n**FINISHED MAIN PIPELINE**\n", encoding="utf-8")
    res = jobs.publication_from_log(spark, str(tmp_path / "logs"), dt.date(2025, 10, 6), None, None, None)
    assert [r.line for r in res.published.collect()] == ['"zal, A1, 10, anna, 10-06",']


def test_mention_posts_merge(spark, tmp_path):
    write(tmp_path / "big" / "a.json", [{"ownerUsername": "u", "caption": "c1", "url": "x1", "timestamp": "t1"},
                                        {"ownerUsername": "v", "caption": "c2", "url": "x2", "timestamp": "t2"}])
    write(tmp_path / "small" / "b.json", [{"ownerUsername": "u", "caption": "c3", "url": "x3", "timestamp": "t3"},
                                          {"ownerUsername": "w", "caption": "c4", "url": "x4", "timestamp": "t4"}])
    posts, counts = jobs.mention_posts(spark, str(tmp_path / "big"), str(tmp_path / "small"))
    c = {r.list: (r.users, r.posts) for r in counts.collect()}
    assert c == {"big": (2, 2), "small": (2, 2), "merged": (3, 4)}
    u_posts = [r.post_url for r in posts.where("influencer_name = 'u'").orderBy("ord").collect()]
    assert u_posts == ["x1", "x3"]                     # big first, then small
