import hashlib
import random

from llm_fixtures import awkward, empty, frame, texts

from promolens.llm.imatch import fingerprints

BAND = (0.05, 0.5)


def test_edited_texts_follow_the_contract(spark):
    rows = sorted(texts(), reverse=True)
    got = {r.doc_id: r for r in fingerprints(frame(spark, rows), BAND).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_equal_texts_and_likeness(spark):
    rows = texts()
    got = {r.doc_id: r for r in fingerprints(frame(spark, rows), BAND).collect()}
    by_text = {}
    for i, t in rows:
        assert by_text.setdefault(t or "", got[i].fingerprint) == got[i].fingerprint
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[30].fingerprint != got[0].fingerprint
    assert got[21].near_next < 1 and got[45].near_next == 1  # 44 and 45 are equal


def test_one_row_and_awkward_rows(spark):
    one = fingerprints(frame(spark, [(5, "abcdef")]), BAND).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one[0].near_next == 1
    assert len(fingerprints(awkward(spark), BAND).collect()) == awkward(spark).count()
    assert len(fingerprints(frame(spark, [(None, "a b"), (None, "c")]), BAND).collect()) == 2
    assert fingerprints(empty(spark), BAND).collect() == []


def test_no_python_in_the_plan(spark):
    plan = fingerprints(frame(spark, texts()), BAND)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_near_copies_that_are_a_third_of_the_rows_are_alike(spark):
    rng = random.Random(4)
    form = [f"form{k}" for k in range(60)]
    copies = [(i, " ".join([*form[:i % 60], f"edit{i}", *form[i % 60 + 1:]])) for i in range(200)]
    others = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(30))) for i in range(200, 600)]
    got = {r.doc_id: r for r in fingerprints(frame(spark, copies + others)).collect()}
    alike = [got[i].near_next for i in range(1, 200)]  # the next is another copy
    assert min(alike) > 0 and sum(alike) / len(alike) > 0.4
    assert got[200].near_next == 0  # the next is a copy, this is none
    assert len({got[i].fingerprint for i in range(200)}) > 150
