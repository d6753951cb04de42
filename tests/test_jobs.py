import datetime as dt

from promolens.plans import jobs
from promolens.sources.tables import caption_table


def posts_df(spark, rows):
    return spark.createDataFrame(rows, "platform string, influencer_name string, caption string, post_url string, post_date string, ord long")


def test_ingest_is_idempotent_and_pipeline_runs(spark, tmp_path):
    wh = jobs.Warehouse(archive=str(tmp_path / "archive"), captions_path=str(tmp_path / "captions"))
    now = dt.datetime(2025, 10, 6, 9, 0)
    rows = [("instagram", "anna", "Use code SUMMER20 at @zalando  for 20% off", "https://p/1", "2025-10-05T10:00:00", 1),
            ("instagram", "anna", "Use code SUMMER20 at @zalando for 20% off", "https://p/1", "2025-10-05T10:00:00", 2),
            ("instagram", "bob", "just a photo", "https://p/2", "2025-10-05T11:00:00", 3),
            ("tiktok", "cat", "met code: hannah15 bij @nakd", "https://t/1", "2025-10-05T12:00:00", 4)]
    counts = {r.platform: tuple(r)[1:] for r in jobs.caption_ingest(spark, posts_df(spark, rows), wh, now).collect()}
    assert counts["instagram"] == (2, 3, 2, 1)
    jobs.caption_ingest(spark, posts_df(spark, rows), wh, now)          # same posts again: no new rows
    assert spark.read.parquet(wh.archive).count() == 3
    table = caption_table(spark, wh.captions_path)
    assert table.count() == 2 and sorted(r.id for r in table.collect()) == [1, 2]

    upd = jobs.analysis_attach(spark, wh, dt.date(2025, 10, 6), None, now)
    assert upd.count() == 2
    analysed = {r.post_url: r.ai_analysis for r in wh.captions(spark).collect()}
    assert analysed["https://p/1"] == '[{"code":"SUMMER20","percentage":20,"webshop":"zalando"}]'

    discounts = spark.createDataFrame([(1, "zalando (x), SUMMER20, 20, q, 09-01"), (2, "nakd, other, 5, q, 09-02")],
                                      "ord long, line string")
    a10 = {r.ai_canonical: r.updated for r in jobs.canonical_attach(spark, wh, dt.datetime(2025, 10, 1), discounts).collect()}
    assert a10 == {"zalando": 1, "nakd": 1}
    lines = jobs.discount_report(spark, wh, dt.datetime(2025, 10, 1), discounts).orderBy("line_no").collect()
    assert [r.line for r in lines] == ['..."zalando, SUMMER20, 20, anna, 10-06",..........09-01    https://p/1',
                                       '"nakd, hannah15, 15, cat_tiktok, 10-06",    https://t/1']
