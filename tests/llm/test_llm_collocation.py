"""Collocations against counts of all word sequences."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from promolens.llm import collocation as C
from promolens.llm.collocation import collocations, count_pairs, first_of_each

from llm_fixtures import SCHEMA, awkward, empty


def brute(rows, least, most_words=5, absorbed_at=100, first=2000):
    """(lang, rank, phrase, a, l, r, n, score) from a count of every sequence."""
    counts, totals, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, most_words + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    for lang, c in counts.items():
        n, own = totals[lang], []
        found = {p: a for p, a in c.items() if a >= least and len(p) > 1}
        dropped = {p[i:j] for p, b in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and 100 * b >= absorbed_at * c[p[i:j]]}
        for p, a in found.items():
            if p not in dropped:
                score, k = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                own.append((-score, -a, " ".join(p).encode(), a, c[p[:k]], c[p[k:]], n, score))
        out += [(lang, i + 1, x[2].decode(), *x[3:]) for i, x in enumerate(sorted(own)[:first])]
    return sorted(out)


def made(seed, n):
    rng = random.Random(seed)
    words = ["red", "Green", "blue", "über", "sky", "x\u001cy", " ", "and", "of"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", "\n", "\u000b", "? "])
                       for _ in range(rng.randrange(30)))
        rows.append((rng.choice(["en", "en", "de", None]), text))
    return rows + [("fr", None), ("fr", ""), ("es", ".,;"), (None, "tail " * 40)]


def result(spark, rows, least, first=2000, **more):
    df = spark.createDataFrame([(i, t, lang, "clash", 7, "dots") for i, (lang, t) in enumerate(rows)], SCHEMA)
    found = first_of_each(collocations(df, least=least, **more), first)
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least, absorbed, more", [(3, 100, {}), (5, 60, {"block_words": 50, "buckets": 3, "broadcast": (0, 0)})])
def test_equal_to_counts_of_all_sequences(spark, least, absorbed, more):
    rows = made(least, 120)
    want = brute(rows, least, absorbed_at=absorbed)
    assert len(want) > 40
    assert result(spark, rows, least, absorbed_at=absorbed, **more) == want


def test_one_language_and_copies_hold_nearly_all_rows(spark):
    rows = [("en", "the same words come back. again and again")] * 300 + made(2, 20)
    assert result(spark, rows, 10, first=4, block_words=400) == brute(rows, 10, first=4)


def test_dense_and_sorted_tiles_count_alike(monkeypatch):
    rng = np.random.default_rng(1)
    x, y = rng.zipf(1.3, 40_000) % 5000, rng.zipf(1.3, 40_000) % 30_000
    weights = rng.integers(1, 9, 40_000)
    for w in (None, weights):
        want = Counter()
        for a, b, v in zip(x.tolist(), y.tolist(), (np.ones(40_000, int) if w is None else w).tolist()):
            want[a, b] += v
        for dense in (100, 1 << 40):
            monkeypatch.setattr(C, "DENSE", dense)
            found = [v.tolist() for v in count_pairs(x, y, w)]
            assert len(found[0]) == len(want) and Counter(dict(zip(zip(*found[:2]), found[2]))) == want


def test_pieces_words_and_exact_scores():
    assert C.words_of("AÄb. c\td\u001ce\n") == [b"a" + "Äb".encode(), b",", b"c", b"d\x1ce", b","]


def test_awkward_and_empty_tables(spark):
    assert collocations(empty(spark)).collect() == []
    assert collocations(awkward(spark), least=2).count() > 10


def test_text_of_several_megabytes(spark):
    rng = random.Random(4)
    text = " ".join(rng.choice(["ab", "cd", "ef", "gh", "ij"]) for _ in range(600_000))
    assert result(spark, [("en", text)], 100, first=30) == brute([("en", text)], 100, first=30)
