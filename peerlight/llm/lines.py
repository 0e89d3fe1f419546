"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlight.llm.common import carried, materialize, passed, releasing, slices, with_carried

BLANKS = b" \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1
# Keys of one file of a run (some 40 bytes each), at most; small runs are not spread over all shuffle partitions.
RUN_KEYS = 100_000


def line_key(line: bytes, least: int) -> bytes | None:
    """128-bit hash of a stripped, lower-cased line, or None when it has under `least` code points."""
    key = line.strip(BLANKS).lower()
    if len(key) < least or (not key.isascii() and len(key.decode()) < least):
        return None
    return xxhash.xxh3_128_digest(key)


def _line_keys(docs: DataFrame, least: int) -> DataFrame:
    """One row (key, doc) per distinct long line of a row; rows without an id count as the last document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                keys: list[bytes] = []
                owners: list[int] = []
                for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                    if text:
                        own = {line_key(x, least) for x in text.encode().split(b"\n")}
                        own.discard(None)
                        keys.extend(own)
                        owners.extend([doc] * len(own))
                yield pa.record_batch({"key": pa.array(keys, pa.binary()), "doc": pa.array(owners, pa.int64())})

    return docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text").mapInArrow(releasing(run), "key binary, doc long")


class LevelledRuns:
    """Sorted runs of (key, first document), compacted when a level holds `fanout` of them.

    A run is a written table, range-partitioned and sorted by key, in files of about `RUN_KEYS` keys. Of its rows, those
    whose `known` is NULL are the run; their keys occur in no other run. The others only say what a batch met.
    """

    def __init__(self, fanout: int = 4):
        self.fanout = fanout
        self.levels: list[list[tuple[DataFrame, int]]] = []

    def all(self) -> DataFrame | None:
        runs = [run for level in self.levels for run, _ in level]
        return reduce(DataFrame.unionAll, runs).filter("known is null").select("key", "first") if runs else None

    def add(self, rows: DataFrame, count: int, level: int = 0) -> DataFrame:
        """Write a run of at most `count` rows (key, first, known, many) and return it."""
        dealt = rows.select("key", "first", "known", "many").repartitionByRange("key").coalesce(max(1, ceil(count / RUN_KEYS)))
        run = materialize(dealt.sortWithinPartitions("key"))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((run, count))
        if len(self.levels[level]) >= self.fanout:
            merged = reduce(DataFrame.unionAll, [other for other, _ in self.levels[level]]).filter("known is null")
            total = sum(size for _, size in self.levels[level])
            self.levels[level] = []
            self.add(merged, total, level + 1)
        return run


def repeated_lines(docs: DataFrame, least: int = 10, batches: int = 4, fanout: int = 4) -> DataFrame:
    """(doc, keys): the line keys each document loses because a smaller doc_id holds them.

    Documents come in `batches` ranges of ascending doc_id, as they would arrive over time. A batch
    is reduced to one row per key (partial sums first, so a line of a third of all documents is no
    hot task), merge-joined with the runs, and only its unseen keys become a new sorted run. Each batch but the last
    is written once, as its run.
    """
    keys = _line_keys(docs, least)
    cuts = sorted(
        set(docs.select(F.coalesce("doc_id", F.lit(LAST)).cast("double").alias("d")).approxQuantile(
            "d", [i / batches for i in range(1, batches)], 0.01
        ))
    ) if batches > 1 else []
    number = sum((F.when(F.col("doc").cast("double") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    table = materialize(keys.withColumn("batch", number))
    counts = {r["batch"]: r["count"] for r in table.groupBy("batch").count().collect()}
    runs = LevelledRuns(fanout)
    lost: DataFrame | None = None
    for b in range(len(cuts) + 1):
        rows = table.filter(F.col("batch") == b)
        first = rows.groupBy("key").agg(
            F.min("doc").alias("first"), (F.min("doc") != F.max("doc")).alias("many")
        )
        seen = runs.all()
        if seen is not None:
            known = seen.select("key", F.col("first").alias("known"))
            first = first.join(known, "key", "left")
        else:
            first = first.withColumn("known", F.lit(None).cast("long"))
        if b < len(cuts):
            first = runs.add(first, counts.get(b, 0))
        owners = first.filter("many or known is not null").select("key", F.coalesce("known", "first").alias("first"))
        drops = rows.join(owners, "key").filter("doc <> first").select("doc", "key")
        lost = drops if lost is None else lost.unionAll(drops)
    return lost.groupBy("doc").agg(F.collect_list("key").alias("keys"))


def dedup_lines(
    docs: DataFrame, least: int = 10, batches: int = 4, fanout: int = 4, carry: list[str] | None = None
) -> DataFrame:
    """Documents with their repeated lines removed: doc_id, n_lines, n_dropped, kept text.

    A line's key is the line stripped of blanks with A-Z lower-cased; keys of at least `least` code
    points held by two or more documents stay only in the smallest doc_id. NULL and empty texts are one
    empty line. Rows that share a doc_id are one document: each loses what a smaller id holds. Rows
    without doc_id count together as one document after all others. Columns named by `carry` come along
    as the struct `carried`; all others are ignored.
    """
    lost = repeated_lines(docs, least, batches, fanout)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for batch in slices(whole, "text"):
                total, dropped, kept = [], [], []
                for text, keys in zip(batch.column("text").to_pylist(), batch.column("keys").to_pylist()):
                    lines = (text or "").encode().split(b"\n")
                    total.append(len(lines))
                    if keys:
                        gone = set(keys)
                        lines = [x for x in lines if line_key(x, least) not in gone]
                    dropped.append(total[-1] - len(lines))
                    kept.append(b"\n".join(lines))
                out = {
                    "doc_id": batch.column("doc_id"),
                    "n_lines": pa.array(total, pa.int64()),
                    "n_dropped": pa.array(dropped, pa.int64()),
                    "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                }
                yield passed(batch, out)

    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), *carried(carry))
    return (
        rows.join(lost, "doc", "left")
        .drop("doc")
        .mapInArrow(releasing(run), with_carried("doc_id long, n_lines long, n_dropped long, kept string", rows))
    )
