import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from llm_fixtures import awkward, empty, frame, texts
from tokenizers import Tokenizer

from promolens.llm.packing import DOCUMENT, GAP, PLACED, WordIds, best_fit, openings, pack, sweep

PATH = public_tokenizers.path("word_bpe_49k.json")


def rounds(counts, capacity):
    """The rounds without Spark: rows (length, rank, n, sequence, offset)."""
    state, opened, out = [(DOCUMENT, length, 0, n, 0, 0) for length, n in counts.items()], 0, []
    while any(r[0] == DOCUMENT for r in state):
        docs = [r for r in state if r[0] == DOCUMENT]
        gaps = [(GAP, *r[1:]) for r in state if r[0] != DOCUMENT]
        if max((g[1] for g in gaps), default=0) < min(d[1] for d in docs):
            more = openings(sum(d[1] * d[3] for d in docs),
                            sum(d[3] for d in docs if 2 * d[1] > capacity), capacity)
            gaps.append((GAP, capacity, opened, more, 0, 0))
            opened += more
        found = sweep(sorted(docs + gaps, key=lambda r: (-r[1], r[0], r[2])), capacity)
        out += [r[1:] for r in found if r[0] == PLACED]
        state = [r for r in found if r[0] != PLACED]
    return out


def sequences(counts, table):
    out, ranks = defaultdict(list), defaultdict(list)
    for length, rank, n, first, offset in table:
        ranks[length] += range(rank, rank + n)
        for k in range(n):
            out[first + k].append((offset, length))
    assert {k: sorted(r) for k, r in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    return out


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


def test_rounds_pack_like_best_fit():
    rng = random.Random(3)
    for _ in range(120):
        capacity = rng.choice([5, 10, 50])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 300)))
        packed = sequences(counts, rounds(counts, capacity))
        assert sum(map(len, packed.values())) == sum(counts.values())
        for places in packed.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(packed) <= best_fit_decreasing(list(counts.elements()), capacity) + 1


def test_rounds_on_spark_with_one_range_and_with_several(spark):
    rng = random.Random(7)
    counts = Counter(rng.randint(1, 40) for _ in range(500))
    table = spark.createDataFrame(list(counts.items()), "length long, n long")
    want = sorted(rounds(counts, 64))
    assert sorted(map(tuple, best_fit(table, 64).collect())) == want
    assert sorted(map(tuple, best_fit(table, 64, range_runs=9).collect())) == want
    assert best_fit(table.limit(0), 64).collect() == []


def check(rows, got, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), capacity):
            own = ids[k:k + capacity]
            want[i, k // capacity, k, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_pieces_are_those_of_the_tokenizer(spark):
    rows = texts() + [(90, "It's 3.5% OF <|endoftext|> <|ENDOFTEXT|> x.,y  \u00c9 E\u0301 don't"),
                      (91, "\u0130 \u03a3\u03a3. \u1e9e \x1c a\x0bb"), (92, "GR\u00dcN \u00c7a, \u00c9T\u00c9."),
                      (93, "\u212b\u2126 \u00aa\u00b2 \u00b5, \ufb01n..  . , rr*** a_ b\"' x' c<|endoftext|> d<| e|>"),
                      (94, "s' t'. 'll 9's. --a- b--c")]
    check(rows, pack(frame(spark, rows), PATH).collect(), 2048)
    check(rows, pack(frame(spark, rows), PATH, capacity=64).collect(), 64)


def test_awkward_rows_and_empty_table(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    check(rows, pack(awkward(spark), PATH).collect(), 2048)
    assert pack(empty(spark), PATH).collect() == []


def test_signs_after_letters_that_become_letter_and_mark(spark):
    rows = [(1, "B\u0130TT\u0130. B\u0130R, \u0130! \u0130st."), (2, "\u0915\u0958. \u0958! \u0958\u0915, \u0915."),
            (3, "\ufb1d. \u05d0\ufb2a, \u05d0."), (4, "\u00c9T\u00c9. gr\u00fcn, \u03a3\u03a3. \u212b; \uac00. \u1100\u1161!")]
    check(rows, pack(frame(spark, rows), PATH).collect(), 2048)


def test_new_words_are_found_without_going_through_the_known_ones():
    """op6: a batch costs by its own words, not by those that the worker remembers."""
    class Watched(WordIds):
        def __iter__(self):
            raise AssertionError("went through all known words")

        keys = items = values = __iter__
    known, tokenizer = Watched(PATH), Tokenizer.from_file(PATH)
    for words in ({"some", "words!", ""}, {"words", "words!", "some", "more?!", "a-b", "!", "1984"}):
        known.learn(words)
        for w in words:
            ids = tokenizer.encode(w, add_special_tokens=False).ids
            assert known[w] == b"".join(i.to_bytes(4, "little") for i in ids)
