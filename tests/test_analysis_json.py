from pyspark.sql import functions as F

from promolens.functions import analysis as A
from promolens.functions.extract import extract_analysis_json
from promolens.operators import report


def test_list_rule_and_fields(spark):
    vals = ['[{"webshop":"A","code":"X10","percentage":10}]', "[]", '{"webshop":"A"}', "null", "not json", "",
            None, '[1,{"webshop":"A"}]', '[{"code":null}]', "[{}]", '[{"webshop":"A","webshop":"B"}]']
    df = spark.createDataFrame([(v,) for v in vals], "a string")
    e = A.parse_list("a")
    got = df.select(F.size(e).alias("n"), A.entries_struct(e).alias("s")).collect()
    assert [r.n for r in got] == [1, 0, None, None, None, None, None, 2, 1, 1, 1]
    assert got[0].s[0].code_display == "X10" and got[0].s[0].pct_display == "10"
    assert [x.pos for x in got[7].s] == [1]          # non-object skipped, still counted
    assert got[8].s[0].code_display == "None"        # JSON null
    assert got[9].s[0].code_display == "N/A"         # missing key
    assert got[10].s[0].webshop == "B"               # last duplicate key wins


def test_entry_texts_are_those_of_the_struct(spark):
    """Exploded entries have the texts of ``entries_struct``, whatever the kind of a field."""
    vals = ['[{"webshop":true,"code":"true","percentage":false}, 3, null, "x", [1]]',
            '[{"webshop":{"b":1,"a":"é"},"code":[1,null],"percentage":1.50},{"webshop":"","code":0,"percentage":"False"}]',
            '[{"webshop":null}]', "[{}]", "[]", None, "{"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, a string")
    names = ["pos", "webshop", "code", "percentage", "code_display", "pct_display", "webshop_csv", "code_csv"]
    want = df.select("i", F.explode(A.entries_struct(A.parse_list("a"))).alias("e")).select("i", "e.*")
    got = A.entry_texts(df.select("i", F.explode(A.entry_fields(A.parse_list("a"))).alias("e")), "e")
    assert got.columns == ["i", *names]
    rows = {tuple(r) for r in got.collect()}
    assert rows == {tuple(r) for r in want.collect()} and len(rows) == 5
    assert (0, 0, "True", "true", "False", "true", "False", "True", "true") in rows
    assert (1, 0, '{"a":"é","b":1}', "[1,null]", "1.5", "[1,null]", "1.5", '{"a":"é","b":1}', "[1,null]") in rows
    assert (3, 0, None, None, None, "N/A", "N/A", "", "") in rows


def test_answers_that_are_no_json_are_left_out(spark):
    df = spark.createDataFrame([(1, ' [1, "é"] '), (2, "null"), (3, "no"), (4, None), (5, "[]")], "i int, raw string")
    assert sorted(tuple(r) for r in A.analysed(df).collect()) == [(1, '[1,"é"]'), (5, "[]")]


def test_many_codes_in_one_caption(spark):
    caption = "@shop " + "code A1B2 and " * 50 + "code metcode is code"
    df = spark.createDataFrame([(caption,), ("code is",), ("Code iscode x",), (None,)], "c string")
    got = [r[0] for r in df.select(extract_analysis_json("c")).collect()]
    assert got == ['[{"webshop":"shop","code":"A1B2","percentage":2}]', "[]", "[]", "[]"]


def test_report_line_rendering(spark):
    from datetime import datetime
    rows = [(1, "instagram", "anna", "https://p/1", datetime(2025, 10, 6, 9), '[{"webshop":"Zal Ando","code":"A10","percentage":10},{"webshop":"X","code":null}]', None),
            (2, "tiktok", "bob", "", datetime(2025, 10, 7, 9), '[{"webshop":"Zal","code":"B1","percentage":"€5"}]', "zal"),
            (3, "tiktok", None, None, datetime(2025, 10, 7, 10), '{"webshop":"Q"}', None)]
    caps = spark.createDataFrame(rows, "id long, platform string, influencer_name string, post_url string, inserted_at timestamp, ai_analysis string, ai_canonical string")
    known = spark.createDataFrame([("zal", "b1", "09-01")], "canonical_key string, code_key string, seen_md string")
    out = report.report_lines(caps, known).orderBy("line_no").collect()
    assert [r.line for r in out] == [
        'MULTI__"___zalando, A10, 10, anna, 10-06",    https://p/1',
        'MULTI__"___zalando, None, N/A, anna, 10-06",    https://p/1',
        '..."zal, B1, €5, bob_tiktok, 10-07",..........09-01',
    ]


def test_rule_extractor(spark):
    df = spark.createDataFrame([("Use code SUMMER20 at @zalando for 20% off",), ("€10 korting met code ANNA",),
                                ("no codes here",)], "c string")
    got = [r[0] for r in df.select(extract_analysis_json("c")).collect()]
    assert got == ['[{"webshop":"zalando","code":"SUMMER20","percentage":20}]',
                   '[{"webshop":null,"code":"ANNA","percentage":"€10"}]', "[]"]


def test_with_analysis_text(spark):
    from promolens.operators import filters
    df = spark.createDataFrame([(1, '[{"webshop":"A","code":"X"}]'), (2, "not json"), (3, None)],
                               "id long, ai_analysis string")
    got = {r.id: r.analysis_text for r in filters.with_analysis(df).collect()}
    assert got == {1: '[{"code":"X","webshop":"A"}]', 2: "not json"}


def test_a_field_text_is_read_once(spark):
    """an entry's webshop is read once for the canonical name and the entry, its code and
    percentage once each (17 reads in the plan before)."""
    lists = ['[{"webshop":false},{"webshop":"False"},{"webshop":0},{"webshop":null},{"webshop":"A b"}]',
             '[{"webshop":"false"}]', '[{"webshop":true}]', '[{"webshop":""},{}]', '[1]', None]
    rows = spark.createDataFrame([(i, "instagram", "n", "u", None, None, x) for i, x in enumerate(lists)],
                                 "id long, platform string, influencer_name string, post_url string,"
                                 " inserted_at timestamp, ai_canonical string, ai_analysis string")
    got = report.explode_entries(rows.coalesce(1))
    # the list, whether an element is an object, and its three texts
    assert got._jdf.queryExecution().executedPlan().toString().count("try_variant_get") == 5
    found = sorted((r.id, r.pos, r.canonical, r.webshop) for r in got.collect())
    assert [f[2] for f in found] == ["___ab"] * 5 + ["___false", "___true", "UNKNOWN", "UNKNOWN"]
    assert [f[3] for f in found] == ["False", "False", "0", None, "A b", "false", "True", "", None]
