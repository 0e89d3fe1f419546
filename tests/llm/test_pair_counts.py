"""Pairs of words counted in packed lists."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from peerlight.llm import collocations


@pytest.mark.parametrize("held", [1, 50, 1 << 20])
def test_pairs_in_packed_lists(spark, held):
    """Counts are those of single rows, whatever a task holds, and tasks send a list per share instead of a row per pair."""
    rnd = random.Random(5)
    chunks = [[rnd.choice([-1, 0, 1, 2, 40, 1 << 20, (1 << 31) - 2]) for _ in range(rnd.randrange(0, 90))] for _ in range(30)]
    want = collections.Counter(p for c in chunks for p in zip(c, c[1:]) if min(p) >= 0)
    corpus = spark.createDataFrame([(bytearray(np.array(c, "<i4").tobytes()),) for c in chunks], "ids binary").repartition(3)
    got = {tuple(r["ids"]): r["f"] for r in collocations.pair_counts(corpus, 4, held=held).collect()}
    assert got == want
    often = {tuple(r["ids"]): r["f"] for r in collocations.pair_counts(corpus, 4, 20, held).collect()}
    assert often == {p: n for p, n in want.items() if n >= 20}
    assert collocations.pair_counts(corpus.limit(0), 1).count() == 0


def test_packed_lists_are_short():
    rnd = np.random.default_rng(3)
    keys = np.unique((rnd.integers(0, 3_000, 50_000) << 32) | rnd.integers(0, 3_000, 50_000))
    counts = rnd.integers(1, 4, len(keys))
    packed = collocations._packed(keys, counts)
    assert len(packed) < 4 * len(keys)
    assert [x.tolist() for x in collocations._unpacked(packed)] == [keys.tolist(), counts.tolist()]


def test_distinct_rows():
    rnd = np.random.default_rng(4)
    for count in (0, 1, 500):
        rows = rnd.choice(np.array([0, 1, 7, (1 << 31) - 1], np.int32), (count, 4))
        for width in (2, 3, 4):
            got = collocations._distinct_rows([rows[:, i] for i in range(width)])
            assert sorted(map(tuple, got.tolist())) == sorted({tuple(r) for r in rows[:, :width].tolist()})


def test_trie_by_table_and_by_search(monkeypatch):
    """Both ways to look up words find the same places, also for numbers beyond those of any phrase."""
    rnd = np.random.default_rng(6)
    phrases = np.unique(rnd.integers(0, 30, (60, 3)).astype(np.int32), axis=0)
    ids = rnd.integers(-1, 45, 5_000).astype(np.int32)
    trie = collocations.DoubleArrayTrie(phrases)
    places, states = trie.states(ids)
    assert trie.table is not None
    want = {tuple(p) for p in phrases.tolist()}
    assert places.tolist() == [i for i in range(len(ids) - 2) if tuple(ids[i : i + 3].tolist()) in want]
    assert (phrases[trie.accepts[states]] == np.stack([ids[places + i] for i in range(3)], 1)).all()
    monkeypatch.setattr(collocations, "TABLE_WORDS", 0)
    again = collocations.DoubleArrayTrie(phrases)
    assert [x.tolist() for x in again.states(ids)] == [places.tolist(), states.tolist()]
