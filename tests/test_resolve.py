import random

from promolens.operators import resolve


def brute(names, keys):
    import re

    def norm(s):
        return re.sub("[^a-z0-9]", "", s.lower())

    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]

    out = {}
    for nm in names:
        n = norm(nm)
        best = None
        for k in keys:
            kn = norm(k)
            if not n or not kn:
                continue
            if n == kn:
                s = 3
            elif (n.startswith(kn) or kn.startswith(n)) and min(len(n), len(kn)) >= 4:
                s = 2
            elif 5 * lev(n, kn) <= max(len(n), len(kn)):
                s = 1
            else:
                continue
            cand = (-s, lev(n, kn) / max(len(n), len(kn)), k)
            best = cand if best is None or cand < best else best
        out[nm] = best[2] if best else "UNKNOWN"
    return out


def run(spark, names, keys):
    u = spark.createDataFrame([(n,) for n in names], "name string")
    k = spark.createDataFrame([(x,) for x in keys], "key string")
    return {r.name: r.canonical for r in resolve.resolve_names(u, k).collect()}


def test_documented_pairs(spark):
    got = run(spark, ["NA-KD", "ZalandoNL", "UnknownShop", "Hm", "Emma"],
              ["nakdfashion", "emmasleepnl", "zalando", "hm", "asos"])
    assert got["ZalandoNL"] == "zalando"
    assert got["UnknownShop"] == "UNKNOWN"
    assert got["Hm"] == "hm"
    assert got["NA-KD"] == "nakdfashion"


def test_matches_brute_force(spark):
    rnd = random.Random(7)
    alphabet = "abcdefghij"
    keys = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(3, 12))) for _ in range(60)]
    names = []
    for k in keys[:40]:
        s = list(k)
        op = rnd.randint(0, 3)
        if op == 0 and len(s) > 1:
            s.pop(rnd.randrange(len(s)))
        elif op == 1:
            s.insert(rnd.randrange(len(s) + 1), rnd.choice(alphabet))
        elif op == 2:
            s[rnd.randrange(len(s))] = rnd.choice(alphabet)
        else:
            s += list("nl")
        names.append("".join(s).upper())
    names += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(2, 14))) for _ in range(40)]
    assert run(spark, names, keys) == brute(names, keys)
