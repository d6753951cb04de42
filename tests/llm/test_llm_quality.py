import random

import numpy as np
from llm_fixtures import awkward, empty, frame, prose
from pyspark.sql import functions as F

from promolens.llm.quality import (OrdinalModel, good_documents, grade_of_labels, gradients, quality_scores)


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        grade = rng.choice([0, 1, 2, 2, 2])
        words = prose(rng, rng.randint(20, 80)).split()
        if grade == 0:
            words = [w.upper() + "!!" for w in words]
        elif grade == 1:
            words[rng.randrange(len(words))] = rng.choice(["vilebad", "vileugly"])
        rows.append((i, " ".join(words), grade))
    return rows


def test_slopes_match_differences():
    rng = np.random.default_rng(0)
    s, y, theta = rng.normal(size=9), rng.integers(0, 3, 9), np.array([-0.4, 0.7])

    def loss(theta, s):
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        p = 1 / (1 + np.exp(-(edges[y + 1] - s))) - 1 / (1 + np.exp(-(edges[y] - s)))
        return -np.log(p).sum()
    g, gt = gradients(theta, s, y)
    for j in range(9):
        e = np.eye(9)[j] * 1e-5
        assert abs((loss(theta, s + e) - loss(theta, s - e)) / 2e-5 - g[j]) < 1e-4
    for j in range(2):
        e = np.eye(2)[j] * 1e-5
        assert abs((loss(theta + e, s) - loss(theta - e, s)) / 2e-5 - gt[j]) < 1e-4


def test_held_out_documents_are_graded(spark):
    rows = corpus(4, 900)
    docs = frame(spark, [(i, t) for i, t, _ in rows])
    grades = spark.createDataFrame([(i, g) for i, _, g in rows if i < 600], "doc_id long, grade int")
    got = {r.doc_id: r for r in quality_scores(docs, grades).collect()}
    held = [(got[i], g) for i, _, g in rows if i >= 600]
    assert np.mean([r.kept for r, g in held if g == 2]) > 0.97
    assert np.mean([r.kept for r, g in held if g == 0]) < 0.05
    assert np.mean([r.kept for r, g in held if g == 1]) < 0.1
    assert all(0 <= r.p_good <= 1 and 0 <= r.expected_grade <= 2 for r in got.values())
    kept = good_documents(docs, grades)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_tails_are_ordered():
    t = OrdinalModel(np.zeros(1), np.array([-1.0, 2.0])).tails(np.array([-3.0, 0.0, 5.0]))
    assert (t[:, 0] >= t[:, 1]).all() and (np.diff(t, axis=0) > 0).all()


def test_awkward_rows(spark):
    grades = spark.createDataFrame([(1, 0), (1, 2), (2, None), (None, 1), (3, 2), (99, 1)], "doc_id long, grade int")
    assert quality_scores(awkward(spark), grades).count() == awkward(spark).count()
    assert quality_scores(empty(spark), grades).collect() == []
    none = quality_scores(awkward(spark), grades.where("false")).collect()
    assert all(r.kept and r.p_good is None for r in none)
    labels = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (None, 1), (0, None), (None, None)], "quality int, toxic int")
    assert [r[0] for r in labels.select(grade_of_labels(F.col("quality"), F.col("toxic"))).collect()] == [
        0, 1, 2, 1, 0, None]
