import random
import zlib

import numpy as np
from llm_fixtures import awkward, empty, frame, prose

from promolens.llm import langid as L


def test_backpropagation_matches_differences():
    rng = random.Random(0)
    net = L.train([(prose(rng, 20, k).encode()[:60], k) for k in ("en", "de") for _ in range(4)], rounds=1, hidden=3)
    net.table, net.turn, net.out, net.bias = (w.astype(np.float64) for w in net.arrays())
    segments, lengths = L.padded([b"the house", b"der", b"unter grau"], 10)
    labels = np.array([1, 0, 0])
    _, slopes = L.loss_slopes(net, segments, lengths, labels)
    for w, g in zip(net.arrays(), slopes, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, ends = w[at], []
        for e in (1e-3, -1e-3):
            w[at] = old + e
            ends.append(L.loss_slopes(net, segments, lengths, labels)[0])
        w[at] = old
        assert abs((ends[0] - ends[1]) / 2e-3 - g[at]) < 1e-3 * max(1, abs(g[at]))


def test_predictions_of_held_out_documents(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(5, 60), ("en", "de")[i % 2])) for i in range(300)]
    docs = frame(spark, rows[::2], "en").union(frame(spark, rows[1::2], "de"))
    got = {r.doc_id: r for r in L.languages(docs).collect()}
    assert len(got) == 300
    for i in got:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i].score <= 1
    held = [i for i in got if got[i].held_out]
    assert np.mean([got[i].lang_pred == ("en", "de")[i % 2] for i in held]) > 0.95


def test_awkward_rows(spark):
    got = L.languages(awkward(spark)).collect()
    assert len(got) == awkward(spark).count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by[i].lang_pred for i in (41, 42, 43)] == ["und"] * 3 and by[41].score == 0
    assert by[44].lang_pred == "en"
    assert L.languages(empty(spark)).collect() == []
    unlabelled = L.languages(frame(spark, [(1, "some text")], None)).collect()
    assert unlabelled[0].lang_pred == "und"
