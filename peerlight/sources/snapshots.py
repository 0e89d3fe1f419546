"""Sinks, snapshots that cut lineage, and the shared folder they live in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from `spark.checkpoint.dir`.

    Only a local session without the setting gets a fresh temporary folder; a cluster without
    it is an error, because a machine-local folder would lose data with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="peerlight-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# The largest method, in bytes, that HotSpot's JIT compiles; Spark's default lets generated ones be eight times as large.
JIT_METHOD_BYTES = 8000


def keep_methods_compilable(spark: SparkSession) -> None:
    """Let Spark split the code of wide stages that the JIT would refuse and run uncompiled.

    Some stages here have a hundred columns or a dozen aggregates, and ran three times as long uncompiled.
    A limit that the session set itself is kept; results do not depend on it.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit, "65535")) == 65535:
        spark.conf.set(limit, str(JIT_METHOD_BYTES))


# Folders that the innermost owner removes, innermost last; written by the driver's threads.
_OWNED: list[list[str]] = []


def _fresh_folder(spark: SparkSession) -> str:
    path = f"{shared_folder(spark)}/peerlight/{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any file system that Spark knows; False when there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def owned_snapshots(spark: SparkSession) -> Iterator[None]:
    """Own the tables that `materialize` writes within the block, and remove them when it ends well.

    After a failure they are left for a look. Nothing that outlives the block may read them.
    """
    _OWNED.append([])
    try:
        yield
    except BaseException:
        _OWNED.pop()
        raise
    for path in _OWNED.pop():
        remove_folder(spark, path)


def materialize(df: DataFrame) -> DataFrame:
    """Compute `df` once into a table of the shared folder and return a scan of that table.

    Cuts lineage, survives lost executors, and gives the planner the true size, so a small
    result is broadcast and a large one is not.
    """
    path = _fresh_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """`materialize`, and aggregates of the written rows, which read only the columns they name.

    `DataFrame.observe` would take them while the rows are written, but a session that has used it can no
    longer run MLlib models: their tasks then fail to serialise.
    """
    table = materialize(df)
    return table, table.agg(*[metric.alias(name) for name, metric in metrics.items()]).first().asDict()


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet snapshot, split by the partition columns that exist.

    Rows are first brought together by those columns, so each value's rows lie in as few files as the adaptive
    target size (`spark.sql.adaptive.advisoryPartitionSizeInBytes`) asks for, not in one file per task; values
    with many rows are still written by many tasks.
    """
    columns = [name for name in partition_by or [] if name in df.columns]
    writer = (df.hint("rebalance", *columns) if columns else df).write.mode("overwrite")
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(path)


def snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> tuple[DataFrame, int]:
    """Write `df`, read it back, and return the new scan with its row count.

    `df` is computed once and nothing is cached: the count reads no column of the written files,
    only their footers.
    """
    write_parquet(df, path, partition_by)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    return saved, saved.count()


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.DISK_ONLY) -> Iterator[DataFrame]:
    """Keep `df` on executor disks for the length of a `with` block."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a CSV export with header; `single_file` is for bounded top-k lists only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def save_json(df: DataFrame, path: str) -> None:
    """Overwrite a JSON-lines artifact (metrics, run records, band counts)."""
    df.write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    """Overwrite a fitted pipeline model."""
    model.write().overwrite().save(path)
