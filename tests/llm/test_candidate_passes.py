"""Pairs and candidates of collocations take little memory of a task."""

from __future__ import annotations

import numpy as np

from peerlight.llm import collocations
from peerlight.llm.common import BATCH_BYTES

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def python_passes(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")


def test_chunks_come_in_bounded_batches(spark):
    """A row of the numbered corpus may have 4 MB, so ten thousand of them are not sent at once."""
    spark.conf.unset(LIMIT)
    try:
        docs = spark.createDataFrame([(1, "a b, a b. a b", "en")], "doc_id long, text string, lang string")
        assert [(r["phrase"], r["a"]) for r in collocations.mine_collocations(docs, min_count=2).collect()] == [("a b", 3)]
        assert spark.conf.get(LIMIT) == str(BATCH_BYTES)
    finally:
        spark.conf.unset(LIMIT)


def test_pairs_are_merged_chunk_by_chunk():
    rnd = np.random.default_rng(5)
    key = total = np.zeros(0, np.int64)
    lists = [np.unique(rnd.integers(0, 60, n), return_counts=True) for n in (0, 1, 30, 90, 40, 0)]
    for some in lists:
        key, total = collocations._merged(key, total, *some)
    want = np.unique(np.concatenate([np.repeat(k, c) for k, c in lists]), return_counts=True)
    assert [key.tolist(), total.tolist()] == [x.tolist() for x in want]


def test_candidates_of_several_tries_come_from_one_pass(spark, monkeypatch):
    seen = []
    materialize = collocations.materialize
    monkeypatch.setattr(collocations, "materialize", lambda df: seen.append(python_passes(df)) or materialize(df))
    corpus = spark.createDataFrame([(bytearray(np.array([0, 1, 2, 3, -1, 1, 2], "<i4").tobytes()),)], "ids binary")
    frequent = spark.createDataFrame([([0, 1],), ([1, 2],), ([2, 3],)], "ids array<int>")
    for size in (100, 1):
        found = collocations.longer_candidates(corpus, frequent, size)
        assert sorted(r["ids"] for r in found.collect()) == [[0, 1, 2], [1, 2, 3]]
    assert seen == [1, 1]
