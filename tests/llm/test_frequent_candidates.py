"""What collocations count by tries follows the phrases that are frequent, not those that occur."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from peerlight.llm import collocations


def numbered(spark, chunks):
    return spark.createDataFrame([(bytearray(np.array(c, "<i4").tobytes()),) for c in chunks], "ids binary").repartition(3)


def occurrences(chunks, length):
    parts = [tuple(c[i : i + length]) for c in chunks for i in range(len(c) - length + 1)]
    return collections.Counter(p for p in parts if min(p) >= 0)


def test_rare_phrases_get_into_no_trie(spark, monkeypatch):
    """Frequent pairs make thousands of rare phrases of three words; only what is frequent costs a place in a trie."""
    sizes = []
    build = collocations.DoubleArrayTrie.__init__
    monkeypatch.setattr(collocations.DoubleArrayTrie, "__init__", lambda self, phrases: sizes.append(phrases.shape) or build(self, phrases))
    rnd = random.Random(8)
    words = [[f"w{rnd.randrange(20)}" for _ in range(100)] + ["new", "york", "city"] for _ in range(200)]
    triples = occurrences([[int(x[1:]) if x[0] == "w" else {"new": 20, "york": 21, "city": 22}[x] for x in w] for w in words], 3)
    assert len(triples) > 7_000 and sum(n >= 20 for n in triples.values()) < 10
    docs = spark.createDataFrame([(i, " ".join(w), "en") for i, w in enumerate(words)], "doc_id long, text string, lang string")
    got = collocations.mine_collocations(docs, longest=3, min_count=20, trie_phrases=700).collect()
    assert ("new york city", 200) in {(r["phrase"], r["a"]) for r in got}
    assert sum(count for count, length in sizes if length == 3) < 10


@pytest.mark.parametrize("held, trie, shares", [(1, 3, 5), (1 << 20, 1 << 20, 1), (60, 100, 3)])
def test_candidates_by_brute_force(spark, held, trie, shares):
    """With any size of tries, lists and shares, candidates are phrases that occur often enough between frequent parts."""
    rnd = random.Random(9)
    chunks = [[rnd.choice([-1, 0, 1, 2, 3, 40, 1 << 20, (1 << 31) - 2]) for _ in range(rnd.randrange(0, 90))] for _ in range(30)] + [[], [-1], [5, 6]]
    corpus = numbered(spark, chunks)
    for length in (1, 2, 3):
        frequent = {p for p, n in occurrences(chunks, length).items() if n >= 4}
        rows = spark.createDataFrame([(list(p),) for p in frequent], "ids array<int>")
        for least in (1, 4):
            got = collocations.longer_candidates(corpus, rows, trie, least, shares, held).collect()
            want = {p for p, n in occurrences(chunks, length + 1).items() if n >= least and p[1:] in frequent and p[:-1] in frequent}
            assert sorted(tuple(r["ids"]) for r in got) == sorted(want)
    assert collocations.longer_candidates(corpus, rows.limit(0), trie, 1, shares, held).count() == 0


@pytest.mark.parametrize("share, trie", [(4, 1 << 20), (1 << 14, 1 << 20), (7, 30)])
def test_trie_counts_in_packed_lists(spark, monkeypatch, share, trie):
    """Tasks send a list per share of a trie's phrases; phrases that nowhere occur have no row."""
    monkeypatch.setattr(collocations, "SHARE_PHRASES", share)
    rnd = random.Random(10)
    chunks = [[rnd.choice([-1, 0, 1, 2, 3, 4, 9]) for _ in range(rnd.randrange(0, 200))] for _ in range(20)]
    phrases = {(rnd.randrange(6), rnd.randrange(6), rnd.randrange(6)) for _ in range(90)}
    rows = spark.createDataFrame([(list(p),) for p in phrases], "ids array<int>")
    got = {tuple(r["ids"]): r["f"] for r in collocations.phrase_counts(numbered(spark, chunks), rows, trie).collect()}
    assert got == {p: n for p, n in occurrences(chunks, 3).items() if p in phrases}
