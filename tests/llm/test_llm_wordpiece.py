import json
import random

from llm_fixtures import awkward, empty, frame, texts

from promolens.llm.wordpiece import WORD, Automaton, byte_alphabet, byte_vocabulary, token_counts


def greedy(word: bytes, vocabulary: set[bytes]) -> int:
    at = n = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_automaton_is_greedy_longest_match():
    rng = random.Random(2)
    for trial in range(60):
        vocabulary = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 14))}
        if trial % 2:
            vocabulary |= {b"a", b"b", b"c"}
        automaton = Automaton(sorted(vocabulary))
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14)))
            assert automaton.count(word) == greedy(word, vocabulary), (word, vocabulary)


def small_vocabulary(tmp_path):
    signs = {b: c for c, b in byte_alphabet().items()}
    tokens = [bytes([b]) for b in range(256)] + [b" the", b"ing", b"ord", b" w", b"xxx", b"xx"]
    path = tmp_path / "vocab.json"
    path.write_text(json.dumps({"added_tokens": [{"content": "<end>"}], "model": {"vocab": {
        **{"".join(signs[b] for b in t): i for i, t in enumerate(tokens)}, "<end>": 999}}}))
    return str(path), set(tokens)


def test_counts_match_brute_force(spark, tmp_path):
    path, tokens = small_vocabulary(tmp_path)
    assert set(byte_vocabulary(path)) == tokens
    rows = texts()
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts(frame(spark, rows), path).collect()}
    for i, t in rows:
        words = WORD.findall(t or "")
        assert got[i] == (len(words), sum(greedy(b" " + w.encode(), tokens) for w in words))


def test_awkward_rows_and_empty_table(spark, tmp_path):
    path, _ = small_vocabulary(tmp_path)
    assert token_counts(awkward(spark), path).count() == awkward(spark).count()
    assert token_counts(empty(spark), path).collect() == []
