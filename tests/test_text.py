from pyspark.sql import functions as F

from promolens import rules
from promolens.functions import text as T


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_normalize_fixture_cases(spark):
    cases = {"a\tb": "ab", "a   b": "a b", "line 1\nline 2": "line 1\nline 2", "x😀": "x😀",
             "r\u00e9duction": "re\u0301duction", "20\u00a0% OFF": "20 % OFF", "  padded \n": "padded",
             "zero\u200bwidth": "zerowidth", "tab\t\tand\r\nCR": "taband\nCR", "line\u2028sep": "linesep",
             "\ufb01n \u2460": "fin 1", "\u00c4\n\n": "A\u0308", "": ""}
    df = spark.createDataFrame([(None,)] + [(c,) for c in cases], "c string")
    got = [r[0] for r in df.select(T.normalize_caption("c")).collect()]
    assert got == ["", *cases.values()]


def test_keyword_match(spark):
    caps = ["20 % OFF", "20% off", "DISCOUNT", "réduction", "plain text", "use my code", None]
    df = spark.createDataFrame([(c,) for c in caps], "c string")
    got = [r[0] for r in df.select(T.keyword_match("c")).collect()]
    assert got == [True, True, True, False, False, True, False]


def test_record_line_helpers(spark):
    line = 'REVIEW_HIGH__"Zalando (nl), AB1, 50, x, 10-06",..........09-15    https://a.b/c'
    assert one(spark, T.strip_review_prefix, line).startswith('"Zalando')
    assert one(spark, T.strip_review_prefix, "REVIEW__x") == "x"
    assert one(spark, T.brand_of_line, line) == "zalando (nl)"
    assert one(spark, T.company_of_record, '"Zalando (nl), AB1"') == "zalando"
    assert one(spark, T.clean_name_cut, "zalando (11 aug) x") == "zalando"
    assert one(spark, T.clean_name_remove_parens, "zalando (11 aug) x") == "zalando x"
    assert one(spark, T.strip_urls, '"a, b",    https://x.y/z  ') == '"a, b",'
    assert one(spark, T.strip_prev_seen_dates, '"a",..........09-15') == '"a",'
    assert one(spark, T.strip_emojis, "a😀b☀️c") == "abc"
    assert one(spark, T.strip_repost_marker, '..."a"') == '"a"'
    assert one(spark, lambda c: T.replace_quoted(c, F.lit("X, Y")), 'pre"a,b"post') == 'pre"X, Y"post'
    assert one(spark, lambda c: T.key_prefix(c, 255), "é" * 300) == "é" * 255
    assert one(spark, lambda c: T.key_prefix(c), "é" * 300) != one(spark, lambda c: T.key_prefix(c), "é" * 301)


def test_keyword_list_is_fixed():
    assert len(rules.CAPTION_KEYWORDS) == 28


def test_python_workers_hold_few_captions_at_once(spark):
    """whatever the rows of a task, a batch of the Python step is small."""
    import pandas as pd
    from pyspark.sql import functions as F
    from pyspark.sql.functions import pandas_udf

    from promolens.session import configure
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    old = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "10000")
        configure(spark)
        size = pandas_udf(lambda texts: pd.Series([len(texts)] * len(texts)), "long")
        df = spark.range(0, 1200, 1, 1).select(F.concat(F.lit("é"), F.col("id").cast("string")).alias("t"))
        assert df.select(F.max(size("t").alias("n"))).first()[0] <= 500
    finally:
        for n, v in zip(names, old, strict=True):
            spark.conf.set(n, v)
