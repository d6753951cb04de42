import datetime as dt

from promolens.operators import publish

TODAY = dt.date(2025, 10, 6)


def lines_df(spark, lines):
    return spark.createDataFrame([(i + 1, l) for i, l in enumerate(lines)], "ord long, line string")


def test_classification_fixture_cases(spark):
    lines = ['"UNKNOWN, A1, 10, x, 10-06",', '"___Gymshark, A1, 10, x, 10-06",', '"shein, AB1, 10, x, 10-06",',
             '"zal, None, 10, x, 10-06",', '..."zal, A1, 10, x, 10-06",..........09-20',
             '..."zal, A1, 10, x, 10-06",..........09-15', '..."zal, A1, 10, x, 10-06",..........12-20',
             '..."zal, A1, 10, x, 10-06",..........02-30', 'no quotes at all']
    got = publish.classify(lines_df(spark, lines), TODAY).orderBy("ord").collect()
    assert [r.reason for r in got] == ["unknown", "ignored", "short_code", "missing_code", "recent",
                                       "keep", "keep", "keep", "keep"]


def test_repair_fixture_cases(spark):
    lines = ['..."zal, A1, 10, x, 10-06",..........09-15', '"shein, ABCDEF, None, x, 10-06",',
             '"zal, A1, None, x, 10-06",', '"a, A1, 40, x",', '"a, A2, 40%, x",', '"a, A3, €100, x",',
             '"a, B1, 41, x",', '"a, B2, €101, x",', '"a, B3, 10€, x",', '"a, B4, N/A, x",',
             '"___New Shop!, A1, 10, x, 10-06",', '"a ,b"', 'REVIEW_X__"a, C1, 99, x",']
    out = publish.repair(lines_df(spark, lines)).orderBy("ord").collect()
    got = [r.line for r in out]
    assert got == ['"zal, A1, 10, x, 10-06",..........09-15', '"shein, ABCDEF, 15, x, 10-06",',
                   '"zal, A1, 10, x, 10-06",', '"a, A1, 40, x",', '"a, A2, 40%, x",', '"a, A3, €100, x",',
                   'REVIEW_HIGH__"a, B1, 41, x",', 'REVIEW_HIGH__"a, B2, €101, x",',
                   'REVIEW_HIGH__"a, B3, 10€, x",', 'REVIEW_HIGH__"a, B4, N/A, x",',
                   '"newshop, A1, 10, x, 10-06",', '"a ,b"', 'REVIEW_X__"a, C1, 99, x",']
    assert [r.stripped for r in out][:2] == [True, False]
    assert [r.defaulted for r in out][1:3] == [True, True]
    assert sum(r.marked for r in out) == 5
    assert out[10].cleaned


def test_multi_and_dedup(spark):
    lines = ['MULTI__"a, X1, 10, u, 10-06",    https://p/1', 'MULTI__"b, X2, 10, u, 10-06",    https://p/1',
             'MULTI__"c, X3, 10, u, 10-06",', '"Zal, AB1, 10, u, 10-06",', '"zal, ab1, 12, v, 10-06",',
             'no quote']
    rep = publish.repair(lines_df(spark, lines))
    kept = publish.collapse_multi(rep)
    got = sorted((r.ord, r.line) for r in kept.collect())
    assert got[0] == (1, '"a, X1, 10, u, 10-06",    https://p/1')
    assert 2 not in [o for o, _ in got]
    assert (3, '"c, X3, 10, u, 10-06",') in got
    surv = publish.dedup_brand_code(kept, seed=1).collect()
    ords = sorted(r.ord for r in surv)
    assert len([o for o in ords if o in (4, 5)]) == 1 and 6 in ords and 1 in ords and 3 in ords
    # same seed, same survivor; the choice depends on the seed only
    again = sorted(r.ord for r in publish.dedup_brand_code(kept, seed=1).collect())
    assert again == ords


def test_publish_end_to_end_invariants(spark):
    lines = [f'"b{i % 7}, C{i}, 10, u, 10-06",    https://p/{i}' for i in range(60)] + ['"zz, Q1, 5, u",']
    hist = spark.createDataFrame(
        [("h", 0, p, f'"b{(p * 3) % 7}, x"') for p in range(30)] + [("h", 1, p, f'"b{p % 7}, x"') for p in range(30)],
        "file string, batch_no long, pos long, line string")
    from promolens.sources.discounts import training_brands
    training = training_brands(None, hist)
    res = publish.publish(lines_df(spark, lines), TODAY, 11, training,
                          r=publish.PublishRules(boosted_brands=("b6",)))
    pub = res.published.orderBy("position").collect()
    assert len(pub) == 61                                   # no (brand, code) duplicates: nothing dropped
    assert [r.position for r in pub] == list(range(1, 62))
    assert all("https://" not in r.line for r in pub)      # URLs stripped from non-review lines
    assert pub[-1].line == '"zz, Q1, 5, u",'                # new company last
    m = {r.metric: r.value for r in res.metrics.collect()}
    assert m["output_lines"] == 61 and m["urls_stripped"] == 60 and m["record_dups_dropped"] == 0
    assert m["input_lines"] == 61 and m["training_batches"] == 2
    assert [m[f"dropped_{r}"] for r in ("unknown", "ignored", "short_code", "missing_code", "recent")] == [0] * 5


def test_publish_without_sort_keeps_input_order(spark):
    lines = ['"b, C1, 10, u, 10-06",    https://p/1', '"a, C2, 50, u, 10-06",', '"UNKNOWN, C3, 5, u, 10-06",',
             '"c, C4, None, u, 10-06",']
    res = publish.publish(lines_df(spark, lines), TODAY, 3, None, sort=False)
    got = [r.line for r in res.published.orderBy("position").collect()]
    assert got == ['"b, C1, 10, u, 10-06",', 'REVIEW_HIGH__"a, C2, 50, u, 10-06",', '"c, C4, 10, u, 10-06",']


def test_lines_are_classified_once(spark, monkeypatch):
    """the counters and the kept lines read one stored classification; no filter
    is left on the parse itself."""
    read = []
    before = publish.stored

    def watched(df, name="stored"):
        read.append(df._jdf.queryExecution().optimizedPlan().toString())
        return before(df, name)
    monkeypatch.setattr(publish, "stored", watched)
    lines = ['"UNKNOWN, A1, 10, x, 10-06",', 'MULTI__"a, X1, None, u, 10-06",    https://p/1',
             'MULTI__"b, X2, 10, u, 10-06",    https://p/1', '..."zal, A1, 10, x, 10-06",..........09-15', None]
    res = publish.publish(lines_df(spark, lines), TODAY, 3, None, sort=False)
    assert len(read) == 3 and "Filter" not in read[0]
    assert sorted((r.ord, r.line, r.reason) for r in res.classified.collect()) == [
        (1, lines[0], "unknown"), (2, lines[1], "keep"), (3, lines[2], "keep"), (4, lines[3], "keep"), (5, None, "keep")]
    got = {r.metric: r.value for r in res.metrics.collect()}
    assert (got["input_lines"], got["dropped_unknown"], got["dropped_multi_dup"], got["defaulted_discount"],
            got["stripped_old_repost"], got["output_lines"]) == (5, 1, 1, 1, 1, 3)
    assert not any("rlike" in line.lower() for line in
                   res.classified._jdf.queryExecution().optimizedPlan().toString().splitlines())


def test_lines_are_parsed_without_patterns(spark):
    """the quoted part is found without regular expressions, and a date is looked for once,
    in reposts only (2 matches, 7 extractions and 3 timestamps in the plan before)."""
    today = dt.date(2001, 6, 30)
    lines = ['"a, b" c', '"a', 'x"" y"z"', '', None, 'no', '..."a", ..........06-30', '...x..........07-01',
             '...x..........02-29', '...x..........13-01 ..........06-01', '"a"..........06-30', '...x.........06-30']
    df = lines_df(spark, lines).coalesce(1)
    parsed = publish.with_reason(publish.parse_line(df), today)
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert ("RLIKE" not in plan and plan.count("regexp_extract") == 1 and "gettimestamp" not in plan)
    got = parsed.orderBy("ord").collect()
    assert [(r.q, r.pre, r.inner, r.rest, r.fields) for r in got[:6]] == [
        (True, "", "a, b", " c", ["a", "b"]), (False, '"a', None, None, None), (True, "x", "", ' y"z"', [""]),
        (False, "", None, None, None), (None, None, None, None, None), (False, "no", None, None, None)]
    assert [r.reason for r in got[6:]] == ["recent", "keep", "keep", "keep", "keep", "keep"]
    seen = df.orderBy("ord").select(publish.prev_seen_date(df["line"], today).alias("d")).collect()
    assert [r.d for r in seen[6:]] == [today, dt.date(2000, 7, 1), None, None, today, None]
