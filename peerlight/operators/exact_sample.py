"""Samples of exactly k rows that do not depend on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: 64-bit hashes are compared as unsigned 60-bit numbers, read from an MD5 of the key.
HASH_DIGITS = 15
# The range that holds the k-th smallest hash is cut into so many buckets until it holds at most so many rows.
BUCKETS = 4096
LAST_ROWS = 10_000


def sample_hash(keys: list[str], seed: int = 42) -> Column:
    """Number below 2^60 of a row's key columns and the seed; NULL keys count as empty text."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("bigint")


def kth_smallest(df: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The k-th smallest value (from 1) of a column of whole numbers, and how many values lie below it.

    Each round counts the rows per bucket of the range at hand and goes on with the bucket that holds the
    k-th; the driver sees one row per bucket. A range of one value, or of `LAST_ROWS` rows, ends the search.
    """
    found = df.agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count(column).alias("rows")).first()
    if not 1 <= k <= found.rows:
        raise ValueError(f"there are {found.rows} values, so none is number {k}")
    low, high, rows, below = found.low, found.high, found.rows, 0
    while low < high:
        here = df.filter(F.col(column).between(F.lit(low), F.lit(high)))
        if rows <= LAST_ROWS:
            values = sorted(row[0] for row in here.select(column).collect())
            value = values[k - below - 1]
            return value, below + sum(v < value for v in values)
        width = -(-(high - low + 1) // BUCKETS)
        bucket = F.expr(f"(`{column}` - {low}) div {width}").alias("bucket")
        for row in sorted(here.groupBy(bucket).count().collect()):
            if below + row["count"] >= k:
                low, rows = low + row.bucket * width, row["count"]
                high = min(high, low + width - 1)
                break
            below += row["count"]
    return low, below


def exact_sample(df: DataFrame, k: int, keys: list[str], seed: int = 42) -> DataFrame:
    """The k rows with the smallest hash of their keys; all rows when there are no more than k.

    Among rows of equal keys at the edge, a hash of all columns decides; rows equal in every column are
    interchangeable. The draw depends on the rows alone: neither partitioning, retries nor row order change
    it, and exactly k rows are drawn. `df` is scanned a few times to find the edge; no row is sorted or shuffled,
    and no hot key gathers in one task.
    """
    if k <= 0:
        return df.limit(0)
    rows = df.withColumn("__hash", sample_hash(keys, seed))
    if rows.count() <= k:
        return df
    edge, below = kth_smallest(rows, "__hash", k)
    sure = rows.filter(F.col("__hash") < F.lit(edge)).select(*df.columns)
    at_edge = rows.filter(F.col("__hash") == F.lit(edge)).select(*df.columns)
    if set(keys) == set(df.columns):
        times = F.explode(F.sequence(F.lit(1), F.lit(k - below))).alias("__time")
        last = at_edge.limit(1).select(*df.columns, times).select(*df.columns)
    else:
        last = exact_sample(at_edge, k - below, df.columns, seed)
    return sure.unionByName(last)
