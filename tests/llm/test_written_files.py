"""How many tables and files line dedup and connected components write."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from peerlight.llm import common, lines


def _written(monkeypatch, module):
    tables = []

    def materialize(df):
        tables.append(original(df))
        return tables[-1]

    original = module.materialize
    monkeypatch.setattr(module, "materialize", materialize)
    return tables


def test_a_batch_is_written_once(spark, monkeypatch):
    """Per batch but the last one run, in few files, whose new keys no other run holds; results are those of one batch."""
    rnd = random.Random(9)
    kinds = [f"a line of text number {i}" for i in range(400)]
    docs = spark.createDataFrame([(i, "\n".join(rnd.sample(kinds, 12))) for i in range(300)], "doc_id long, text string").repartition(5)
    whole = {r["doc_id"]: r["kept"] for r in lines.dedup_lines(docs, batches=1).collect()}
    tables = _written(monkeypatch, lines)
    for fanout in (2, 4):
        tables.clear()
        got = {r["doc_id"]: r["kept"] for r in lines.dedup_lines(docs, batches=4, fanout=fanout).collect()}
        assert got == whole
        runs = tables[1:]
        assert len(runs) == (4 if fanout == 2 else 3)
        assert all(len(run.inputFiles()) == 1 for run in runs)
    new = [r["key"] for run in runs for r in run.filter("known is null").collect()]
    assert len(new) == len(set(map(bytes, new)))


def test_rounds_of_components_are_few_files(spark, monkeypatch):
    """Tables of late rounds have files in proportion to their rows, not one per shuffle partition."""
    tables = _written(monkeypatch, common)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + F.when(F.col("id") % 100 == 99, 0).otherwise(1)).alias("b"))
        found = {r["node"]: r["component"] for r in common.connected_components(edges, "a", "b").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {i: i // 100 * 100 for i in range(300)}
    assert max(len(t.inputFiles()) for t in tables[1:]) <= 2
