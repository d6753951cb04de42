"""Periodic runs against a search over all periods."""
import hashlib
import random
import zlib

import pytest

from promolens.llm import queries
from promolens.llm.periodic import periodic_runs, runs_of_texts

from llm_fixtures import SCHEMA, awkward, empty, frame, texts


def brute(words, least=6, exponent=4):
    """All runs, from the longest stretch of every period; the smallest period of equal ones."""
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


def made(rng):
    k, n = rng.choice([1, 2, 2, 3, 4]), rng.randint(0, 90)
    w = [rng.choice("abcd"[:k]) for _ in range(n)]
    if n and rng.random() < 0.7:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 9)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.5:
            w[rng.randrange(n)] = "x"
    return [c.encode() for c in w]


def test_runs_are_those_of_a_search_over_all_periods():
    rng = random.Random(3)
    for _ in range(400):
        some = [made(rng) for _ in range(rng.randint(1, 4))]
        found = [[tuple(r) for r in f.tolist()] for f in runs_of_texts(some, 6, 4)]
        assert found == [brute(t) for t in some]


@pytest.mark.parametrize("text", ["a" * 3000, ("ab" * 40 + "c") * 30, ("aab" * 10 + "b") * 20,
                                  "".join("ab" if c == "a" else "a" for c in "abaababaabaab" * 60)])
def test_strongly_periodic_texts(text):
    words = [c.encode() for c in text]
    assert [tuple(r) for r in runs_of_texts([words], 6, 4)[0].tolist()] == brute(words)


def expected(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def test_query_on_awkward_rows(spark, monkeypatch):
    extra = [(60 + i, " ".join(["la la la la la la stop"] * (i % 5) + ["one two"] * i)) for i in range(40)]
    rows = texts() + extra + texts()[:3] + [(None, "a a a a a a a"), (None, None), (300, "x y " * 9 + "  x\u001cy")]
    monkeypatch.setattr(queries, "_table", lambda *a: frame(spark, rows))
    out = queries.op12_periodic_runs(spark, "")
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    key = repr
    assert sorted(map(tuple, out.collect()), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_operator_returns_runs_and_text(spark):
    rows = periodic_runs(frame(spark, [(1, "go " * 8 + "home"), (2, None), (3, "a b " * 3)])).collect()
    by_id = {r.doc_id: r for r in rows}
    assert [tuple(x) for x in by_id[1].runs] == [(0, 8, 1)] and by_id[1].collapsed == "go home"
    assert by_id[2].n_words == 0 and by_id[2].runs == [] and by_id[2].collapsed == ""
    assert by_id[3].runs == [] and by_id[3].collapsed == "a b a b a b"
    assert periodic_runs(awkward(spark)).count() == awkward(spark).count()


def test_empty_table(spark):
    assert periodic_runs(empty(spark)).collect() == []
    assert SCHEMA.names[:2] == ["doc_id", "text"]


def test_text_of_several_megabytes(spark):
    rng = random.Random(5)
    words = [str(rng.randrange(500)) for _ in range(700_000)]
    words[300_000:300_000 + 90_000] = [words[300_000 + i % 9000] for i in range(90_000)]
    [row] = periodic_runs(frame(spark, [(1, " ".join(words))])).collect()
    assert any(r.start <= 300_000 and r.length >= 90_000 and r.period == 9000 for r in row.runs)


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        runs_of_texts([[b"a"] * 9], 6, 3)
