"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes.  Every node knows, for the case that the
next byte does not continue it, how many tokens its string gives up ("pops")
and at which node the rest of its string continues (the failure link).  One
pass over a word's bytes then counts its greedy longest-match tokens, in time
linear in the word, without building a single piece.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, kept_by_worker, received, send, ship, small_batches

#: Words: runs of letters, digits and underscores, or single other signs.
WORD = re.compile(r"\w+|[^\w\s]")
#: Distinct words whose counts a worker remembers before it starts anew.
MEMO_WORDS = 800_000


def byte_alphabet() -> dict[str, int]:
    """The sign that a byte-level vocabulary file writes for each byte.

    Printable Latin-1 signs stand for themselves; the other bytes, in order,
    are written as the code points from 256 on.
    """
    plain = [b for r in ((33, 127), (161, 173), (174, 256)) for b in range(*r)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_vocabulary(path: str) -> list[bytes]:
    """The tokens of a byte-level vocabulary file, as bytes; special ones left out."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    special = {t["content"] for t in content.get("added_tokens", ())}
    signs = byte_alphabet()
    return [bytes(signs[c] for c in t) for t in content["model"]["vocab"] if t not in special]


class Automaton:
    """Trie of the vocabulary with failure links and popped-token counts."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.child: dict[int, int] = {}  # node << 8 | byte -> node
        final = [False]
        links: list[list[tuple[int, int]]] = [[]]
        for token in vocabulary:
            node = 0
            for b in token:
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = len(final)
                    self.child[node << 8 | b] = nxt
                    links[node].append((b, nxt))
                    final.append(False)
                    links.append([])
                node = nxt
            final[node] = node > 0
        n = len(final)
        self.fail, self.pops = [-1] * n, [0] * n
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for b, v in links[u]:
                if final[v]:
                    self.fail[v], self.pops[v] = 0, 1
                else:
                    z, popped = self.fail[u], self.pops[u]
                    while z >= 0 and (z << 8 | b) not in self.child:
                        popped += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.child[z << 8 | b], popped
                queue.append(v)
        # tokens that a node's whole string gives; -1 where it cannot be split
        self.whole = [-1] * n
        self.whole[0] = 0
        for node in range(1, n):
            at, count = node, 0
            while at > 0:
                count += self.pops[at]
                at = self.fail[at]
            self.whole[node] = count if at == 0 else -1

    def count(self, word: bytes) -> int:
        """Greedy longest-match tokens of a word; 1 (unknown) if it has no such split."""
        child, fail, pops = self.child, self.fail, self.pops
        node = tokens = 0
        for b in word:
            nxt = child.get(node << 8 | b)
            while nxt is None:
                tokens += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
                nxt = child.get(node << 8 | b)
            node = nxt
        return tokens + self.whole[node] if self.whole[node] >= 0 else 1


class WordCounts(dict):
    """Token counts of the words seen so far, each written after a space."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        # lone halves of surrogate pairs cannot reach here: Spark strings are UTF-8
        found = self[word] = self.automaton.count(b" " + word.encode("utf-8"))
        return found


def word_counts(vocabulary_path: str, shared: Broadcast) -> WordCounts:
    """The counts that this worker knows for the vocabulary, from task to task."""
    return kept_by_worker(f"counts {vocabulary_path}", lambda: WordCounts(received(shared, Automaton)))


def text_counts(text: str | None, counts: WordCounts) -> tuple[int, int]:
    """(words, tokens) of a text."""
    words = WORD.findall(text or "")
    return len(words), sum(map(counts.__getitem__, words))


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_tokens``.

    Words are runs of letters, digits and underscores, or single other signs;
    each is split, after a leading space, into the longest tokens of the
    vocabulary from the left.  Null and empty texts have 0 words; a word that
    the vocabulary cannot split counts as one unknown token; words of any length
    take linear time.  Repeated rows and null ids give a row each; an empty
    table gives none; other columns are ignored.  The vocabulary file is read by
    the driver and its automaton, whose size does not depend on the corpus, is
    sent to the executors.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = send(spark, Automaton(byte_vocabulary(vocabulary_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(vocabulary_path, shared)
        for batch in batches:
            found = [text_counts(t, counts) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([w for w, _ in found], pa.int64()),
                 pa.array([t for _, t in found], pa.int64())], ["doc_id", "n_words", "n_tokens"])
    base = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return base.mapInArrow(run, "doc_id long, n_words long, n_tokens long")


ship(__name__)
