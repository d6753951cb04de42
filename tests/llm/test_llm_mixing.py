import random

import numpy as np
import public_tokenizers
from llm_fixtures import awkward, empty, frame, prose
from pyspark.sql import functions as F

from promolens.llm import mixing, wordpiece
from promolens.llm.mixing import mix, times_used

PATH = public_tokenizers.path("byte_bpe_50k.json")


def corpus(n=240, seed=2):
    rng = random.Random(seed)
    return [(i, prose(rng, rng.randint(5, 60), "de" if i % 4 == 0 else "en")) for i in range(n)]


def labelled(spark, rows):
    return spark.createDataFrame([(i, "de" if i % 4 == 0 else "en") for i, _ in rows if i % 3], "doc_id long, domain string")


def nearest(tokens, posterior, targets, least):
    """Brute force: dual ascent on the whole problem in numpy, many small steps."""
    moves = np.zeros(posterior.shape[1])
    gram = (posterior * tokens[:, None]).T @ posterior
    for _ in range(20000):
        rate = np.maximum(least, 1 - posterior @ moves)
        moves += 0.2 * np.linalg.solve(gram, posterior.T @ (rate * tokens) - targets)
    return np.maximum(least, 1 - posterior @ moves)


def test_rates_are_the_nearest_that_meet_the_targets(spark):
    rows = corpus()
    for weights, total, least in (({"de": 0.5, "en": 0.5}, None, 0.0), ({"de": 0.05, "en": 0.95}, 9000.0, 0.0),
                                  ({"de": 0.6, "en": 0.4}, None, 1.0)):
        got = sorted(mix(frame(spark, rows), labelled(spark, rows), PATH, weights, total, least).collect())
        tokens = np.array([r.n_tokens for r in got], float)
        posterior = np.array([r.posterior for r in got])
        rate = np.array([r.rate for r in got])
        sums = posterior.T @ (rate * tokens)
        assert np.allclose(sums / sums.sum(), [weights["de"], weights["en"]], atol=1e-4)
        assert total is None or abs(sums.sum() - total) < 1
        assert (rate >= least).all()
        assert np.allclose(rate, nearest(tokens, posterior, sums, least), atol=1e-3)
        assert np.allclose(posterior.sum(axis=1), 1)
        assert np.mean([r.domain == ("de" if r.doc_id % 4 == 0 else "en") for r in got]) > 0.97


def test_default_targets_cut_no_domain(spark):
    rows = corpus()
    got = mix(frame(spark, rows), labelled(spark, rows), PATH).collect()
    assert min(r.rate for r in got) > 0.95


def test_whole_uses_average_to_the_rate(spark):
    df = spark.range(20000).select(F.lit(1.3).alias("rate"), "id")
    mean = df.agg(F.avg(times_used(F.col("rate"), F.col("id")))).first()[0]
    assert abs(mean - 1.3) < 0.02


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (2, None), (None, "a"), (41, "a")],
                                   "doc_id long, domain string")
    assert mix(awkward(spark), labels, PATH).count() == awkward(spark).count()
    assert mix(empty(spark), labels, PATH).collect() == []
    alone = mix(awkward(spark), labels.where("false"), PATH).collect()
    assert {r.rate for r in alone} == {1.0} and len(alone) == awkward(spark).count()
    impossible = mix(frame(spark, corpus(40)), labels, PATH, {"a": 0.5, "zzz": 0.5}).collect()
    assert all(r.rate >= 0 for r in impossible)


def rare_corpus():
    latin = "arma virumque cano troiae qui primus ab oris italiam fato profugus".split()
    rng = random.Random(5)
    return [(i, " ".join(rng.choices(latin, k=30)) if i in (301, 733) else t) for i, t in corpus(900)]


def test_a_rare_domain_is_kept_and_meets_its_target(spark):
    rows = rare_corpus()
    labels = spark.createDataFrame([(i, "la" if i in (301, 733) else "de" if i % 4 == 0 else "en") for i, _ in rows],
                                   "doc_id long, domain string")
    got = mix(frame(spark, rows), labels, PATH, {"de": 0.4, "en": 0.5, "la": 0.1}, 30000.0, fit_rows=60).collect()
    posterior = np.array([r.posterior for r in got])
    assert {r.doc_id for r in got if r.domain == "la"} == {301, 733}
    assert np.mean([r.domain == ("de" if r.doc_id % 4 == 0 else "en") for r in got if r.domain != "la"]) > 0.97
    sums = posterior.T @ np.array([r.rate * r.n_tokens for r in got])
    assert np.allclose(sums, [12000, 15000, 3000], atol=5)


def test_a_weight_without_documents_does_not_raise_the_others(spark):
    rows = corpus()
    got = mix(frame(spark, rows), labelled(spark, rows), PATH, {"de": 0.4, "en": 0.4, "zzz": 0.2}, 10000.0).collect()
    sums = np.array([r.posterior for r in got]).T @ np.array([r.rate * r.n_tokens for r in got])
    assert np.allclose(sums, [4000, 4000, 0], atol=5)


def test_known_words_count_and_place_like_the_plain_way(monkeypatch):
    """One look-up a word gives the tokens and places of the plain way, also when words are
    forgotten between texts and when one text has more words than are kept."""
    automaton = wordpiece.Automaton([bytes([b]) for b in range(256)] + [b" w", b"ab", b" ab1"])
    texts = ["", "ab1 AB1 a1b2c3 ?! 12", " ".join(f"w{i}x é{i % 7}" for i in range(60)), "a1b2c3 w1x ab1", "12 !"]
    for kept in (1000, 8):
        monkeypatch.setattr(mixing, "MEMO_WORDS", kept)
        known = mixing.KnownWords(automaton)
        for text in texts + texts[::-1]:
            words = wordpiece.WORD.findall(text)
            places = {mixing.slot(p) for w in words for p in mixing.LETTERS.findall(w.lower())}
            count, found = known.read(text)
            assert count == sum(automaton.count(b" " + w.encode()) for w in words)
            assert found.tolist() == sorted(places)
            assert sorted(mixing.word_slots(words, mixing.WordSlots())) == sorted(places)
