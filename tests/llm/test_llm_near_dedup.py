import random
from itertools import combinations

import numpy as np
from llm_fixtures import awkward, empty, frame, prose, texts

from promolens.llm import near_dedup as N
from promolens.llm.components import components


def shingles(text, size):
    words = text.encode().lower().split()
    return ({tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
            or ({tuple(words)} if words else set()))


def brute(rows, size=5, percent=80):
    sets = {i: shingles(t or "", size) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {(i, len(sets[i]), find(i), find(i) == i) for i in sets}


def chained(seed=5):
    """A group whose members drift: many are like their neighbours only."""
    rng = random.Random(seed)
    rows, words = [], prose(rng, 120).split()
    for i in range(60):
        rows.append((100 + i, " ".join(words)))
        words = list(words)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = texts() + chained()
    for size in (4, 5):
        got = {tuple(r) for r in N.near_dedup(frame(spark, rows), size).collect()}
        assert got == brute(rows, size)


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7)
    rows = chained(8)
    assert {tuple(r) for r in N.near_dedup(frame(spark, rows), 4).collect()} == brute(rows, 4)


def test_sketch_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (3, 40, 2000):
        agree = []
        for _ in range(60):
            pool = np.unique(rng.integers(0, 2 ** 63, n * 10 // 9 + 1, dtype=np.uint64) * np.uint64(2))
            a, b = pool[:n], pool[len(pool) - n:]
            agree.append((N.sketch(a) == N.sketch(b)).mean())
        same = len(np.intersect1d(a, b))
        assert abs(np.mean(agree) - same / (2 * n - same)) < 0.08


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 90)] + [(200, 300), (300, 200), (5, 5), (400, 90)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in [*range(91), 400]} | {(200, 200), (300, 200)}


def test_awkward_rows_and_empty_table(spark):
    got = N.near_dedup(awkward(spark)).collect()
    assert len(got) == awkward(spark).count()
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert all(r.component_id == r.doc_id for r in got if r.n_shingles == 0)
    assert N.near_dedup(empty(spark)).collect() == []
