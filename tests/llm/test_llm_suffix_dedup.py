import hashlib
import random

import numpy as np
from llm_fixtures import awkward, empty, frame, texts

from promolens.llm import suffix_dedup as S


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_order_and_common_prefixes():
    rng = random.Random(5)
    for _ in range(150):
        base = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 120))) for _ in range(4)]
        strings = []
        for _ in range(rng.randint(1, 40)):
            b = rng.choice(base)
            strings.append(b[:rng.randint(0, len(b))] + bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 6))))
        groups = np.array([rng.randint(0, 2) for _ in strings])
        order, lcp = S.sorted_suffixes(groups, strings)
        keys = [(groups[i], strings[i]) for i in order]
        assert keys == sorted(keys)
        for k in range(len(order)):
            first = k == 0 or keys[k][0] != keys[k - 1][0]
            assert lcp[k] == (-1 if first else common(keys[k][1], keys[k - 1][1]))


def test_multikey_quicksort_orders_by_group_and_words():
    rng = np.random.default_rng(6)
    for n in (1, 2, 3, 50, 3000):
        for values in (1, 2, 40, 1 << 60):  # all equal to all different
            groups, words = rng.integers(0, 4, n), rng.integers(0, values, (n, 3)).astype(np.uint64) << np.uint64(3)
            order = S.multikey_quicksort(groups, words)
            want = sorted(range(n), key=lambda i: (groups[i], *words[i]))
            assert order.tolist() == want
    ordered = np.arange(5000, dtype=np.uint64)[:, None]
    assert S.multikey_quicksort(np.zeros(5000, int), ordered[::-1]).tolist() == list(range(5000))[::-1]


def passages(seed=4):
    """Texts of shared, changed and periodic parts."""
    rng = random.Random(seed)
    parts = ["".join(rng.choice("abcdé gh ") for _ in range(rng.randint(300, 1200))) for _ in range(4)]
    rows = []
    for i in range(30):
        text = ""
        for _ in range(rng.randint(1, 3)):
            p = list(rng.choice(parts))
            for _ in range(rng.randint(0, 2)):
                p[rng.randrange(len(p))] = rng.choice("xyz")
            a = rng.randint(0, len(p) // 2)
            text += "".join(p[a:a + rng.randint(100, 1200)]) + "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60)))
        if i % 7 == 0:
            text += rng.choice(["a", "To ", "xyzzy, "]) * rng.randint(1, 300)
        rows.append((500 + i, text))
    return rows + [(600, rows[3][1]), (601, rows[3][1])]


def brute(rows):
    data, seen = [(i, (t or "").encode()) for i, t in rows], {}
    for _, x in data:
        for k in range(len(x) - 399):
            seen[x[k:k + 400]] = seen.get(x[k:k + 400], 0) + 1
    out = []
    for i, x in data:
        gone = bytearray(len(x))
        for k in range(len(x) - 399):
            if seen[x[k:k + 400]] > 1:
                gone[k:k + 400] = b"\1" * 400
        kept = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(x), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def test_matches_brute_force_in_every_path(spark):
    rows = texts() + passages()
    want = sorted(brute(rows))
    for task_anchors in (S.TASK_ANCHORS, 6, 1):
        got = S.remove_repeats(frame(spark, rows), task_anchors, texts=True).collect()
        assert sorted((*tuple(r)[:5], bytes(r.kept)) for r in got) == want


def test_awkward_rows_and_empty_table(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    got = S.remove_repeats(awkward(spark)).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, (r[:5] for r in brute(rows))))
    assert S.remove_repeats(empty(spark)).collect() == []
