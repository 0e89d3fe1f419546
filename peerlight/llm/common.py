"""Helpers the operators share: tables, word bytes, lineage cuts and connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peerlight.sources.snapshots import materialize

# Bytes after A-Z are lower-cased and every byte outside [0-9a-z] and the non-ASCII range is a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

# Bytes after which Spark ends a batch it sends to a Python worker. Its default counts rows alone (10,000), so that rows of
# 4 MB, or just long texts, lie in memory whole: in the JVM, in the worker and in what the worker makes of them.
BATCH_BYTES = 8 << 20

# Rows of one file of a round of `connected_components`, at most: late rounds are small and need no task per shuffle partition.
ROUND_ROWS = 100_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Let batches for Python workers end after `BATCH_BYTES`; a limit that the session set itself is kept."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(BATCH_BYTES))


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text as UTF-8 bytes, A-Z lower-cased; none for NULL."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the texts of a column reach `limit` bytes, so one step's memory is bounded."""
    lengths = batch.column(column).nbytes
    if lengths <= limit or batch.num_rows <= 1:
        yield batch
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    step = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:]):
        yield batch.slice(low, high - low)


def release_memory() -> None:
    """Give freed memory back to the system: workers live on between stages and count against their executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run` for a task whose worker gives its memory back when the task ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return task


def carried(columns: list[str] | None) -> list[Column]:
    """Columns that travel with a row through an operator, as one struct whose fields clash with nothing."""
    return [F.struct(*[F.col(c) for c in columns]).alias("carried")] if columns else []


def with_carried(ddl: str, rows: DataFrame) -> StructType:
    """An operator's result schema, with the carried struct of its input rows if they have one."""
    schema = StructType.fromDDL(ddl)
    return schema.add("carried", rows.schema["carried"].dataType) if "carried" in rows.columns else schema


def passed(batch: pa.RecordBatch, out: dict) -> pa.RecordBatch:
    """A result batch, with the carried struct of the input batch if it has one."""
    if "carried" in batch.schema.names:
        out["carried"] = batch.column("carried")
    return pa.record_batch(out)


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of an edge list; the component is its smallest node.

    Each round points every node to its smallest neighbour and contracts the edges to the targets,
    which at least halves the nodes that still have edges, so a few rounds are enough for any shape.
    Rounds are written tables of the shared folder, in files of about `ROUND_ROWS` rows; nothing is gathered by the driver.
    """
    rest = materialize(
        edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a is not null and b is not null and a <> b").distinct()
    )
    maps: list[DataFrame] = []
    while count := rest.count():
        files = ceil(count / ROUND_ROWS)
        both = rest.unionAll(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(2 * files))
        maps.append(step)
        rest = materialize(
            rest.join(step, "a")
            .select(F.col("m").alias("x"), "b")
            .join(step.select(F.col("a").alias("b"), F.col("m").alias("y")), "b")
            .filter("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct()
            .coalesce(files)
        )
    if not maps:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = maps[0].select(F.col("a").alias("node"), F.col("m").alias("component"))
    for step in maps[1:]:
        moved = step.select(F.col("a").alias("component"), F.col("m").alias("__to"))
        labels = labels.join(moved, "component", "left").select(
            "node", F.coalesce("__to", "component").alias("component")
        )
    return labels


def small_components(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of `count` nodes over the edges (a, b) of one task."""
    label = np.arange(count)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label
