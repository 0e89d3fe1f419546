"""Target-distribution importance resampling: hashed n-gram weights, Gumbel scores, a distributed radix sort."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlight.llm.common import slices, words_of
from peerlight.sources.snapshots import materialize

# Rows of one counting-sort block, and bits of one digit: a block's counts are at most an eighth of its rows.
BLOCK_ROWS = 2048
DIGIT_BITS = 8
# Blocks whose counts are summed as one run.
RUN_BLOCKS = 1024
# Buckets of distinct features a worker remembers before it starts anew.
REMEMBERED = 200_000

Field = tuple[Column, int]


class Buckets:
    """Bucket of each feature of a text: crc32 of its bytes modulo the number of buckets."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest, self.known = buckets, longest, {}

    def of(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        found = []
        for n in range(1, self.longest + 1):
            grams = words if n == 1 else [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
            known = self.known
            for gram in set(grams).difference(known):
                known[gram] = zlib.crc32(gram) % self.buckets
            found.append(np.fromiter(map(known.__getitem__, grams), np.int64, len(grams)))
        if len(self.known) > REMEMBERED:
            self.known = {}
        return np.concatenate(found)


def bucket_counts(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """(bucket, features): features of all texts per bucket. Every task sends one row per bucket it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = Buckets(buckets, longest), np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                for text in batch.column("text").to_pylist():
                    total += np.bincount(own.of(text), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.record_batch({"bucket": hit, "features": total[hit]})

    return texts.select("text").mapInArrow(count, "bucket long, features long").groupBy("bucket").agg(F.sum("features").alias("features"))


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandfold log ratio of a bucket's smoothed share of the target and of the source, rounded down."""
    all_s, all_t, size = float(source.sum()), float(target.sum()), float(len(source))
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (all_s + size) / ((s + 1) * (all_t + size)))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def weighed(docs: DataFrame, gains: np.ndarray, longest: int, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row, by a look-up of all features in the gain array."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Buckets(len(gains), longest)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids = batch.column("doc_id")
                rows = []
                for doc, text in zip(ids.to_pylist(), batch.column("text").to_pylist()):
                    found = own.of(text)
                    n = len(found)
                    words = n if longest == 1 else len(words_of(text))
                    weight = int(gains[found].sum()) // n if n else 0
                    h = int(sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
                    rows.append((words, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
                n_words, n, weight, total = (pa.array(x, pa.int64()) for x in zip(*rows)) if rows else [pa.array([], pa.int64())] * 4
                yield pa.record_batch({"doc_id": ids, "n_words": n_words, "n_features": n, "weight": weight, "score": total})

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def _digits(fields: list[Field]) -> list[Column]:
    """Digits, least first, of the composite key whose least significant field comes first."""
    bits = sum(width for _, width in fields)
    digits = []
    for low in range(0, bits, DIGIT_BITS):
        digit, start = F.lit(0).cast("long"), 0
        for field, width in fields:
            first, last = max(low, start), min(low + DIGIT_BITS, start + width)
            if first < last:
                part = F.shiftrightunsigned(field, first - start).bitwiseAND(F.lit((1 << (last - first)) - 1))
                digit = digit.bitwiseOR(F.shiftleft(part, first - low))
            start += width
        digits.append(digit.cast("int"))
    return digits


def radix_ranks(rows: DataFrame, ascending: list[Column], rank: str = "rank") -> DataFrame:
    """`rows` with their rank from 1 in the order of the given bigint keys, the most significant first.

    Least-significant-digit radix sort. Keys are joined to one composite key, each counted from its least value, NULL
    after all values. A pass is a stable counting sort by one digit: rows are counted per
    digit and block, global prefix sums of the counts give each block's first destination for the digit, and
    a row's place among its block's rows with that digit is added. Blocks hold `BLOCK_ROWS` rows, so no task
    depends on a digit's or key's frequency. Each pass is a written table. Ranks of rows with equal keys
    follow the first table's order.
    """
    names = [f"__key_{i}" for i in range(len(ascending))]
    # Positions number the rows of a written table; a scan of it numbers them alike in every attempt of a task.
    now = materialize(rows.select("*", *[key.alias(name) for key, name in zip(ascending, names)]))
    seen = now.agg(
        *[c for name in names for c in (F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max"), F.max(F.col(name).isNull()).alias(f"{name}_null"))],
    ).first()
    fields: list[Field] = []
    for name in reversed(names):
        low, high = seen[f"{name}_min"], seen[f"{name}_max"]
        if low is not None and low != high:
            if high - low < 1 << 63:
                number, width = F.col(name) - F.lit(low).cast("long"), (high - low).bit_length()
            else:
                # With its sign bit flipped, two's complement sorts like an unsigned number.
                number, width = F.col(name).bitwiseXOR(F.lit(-(1 << 63)).cast("long")), 64
            fields.append((F.coalesce(number, F.lit(0).cast("long")), width))
        if seen[f"{name}_null"]:
            fields.append((F.col(name).isNull().cast("long"), 1))
    # Without any difference a single pass of equal digits numbers the rows in their table's order.
    found = _digits(fields) or [F.lit(0)]
    digits = [f"__digit_{i}" for i in range(len(found))]
    state = now.select(*rows.columns, *[d.alias(n) for d, n in zip(found, digits)], F.monotonically_increasing_id().alias("__at"))
    for position, digit in enumerate(digits):
        placed = state.withColumn("__block", F.floor(F.col("__at") / BLOCK_ROWS))
        if position == 0:
            # Row numbers of a scan have gaps between its tasks, which only the block numbers show.
            placed = materialize(placed)
        counts = placed.groupBy("__block", F.col(digit).alias("__digit")).agg(F.count(F.lit(1)).alias("rows"))
        starts = _prefix_sums(materialize(counts))
        own = Window.partitionBy("__block", "__digit").orderBy("__at")
        state = (
            placed.withColumn("__digit", F.col(digit))
            .withColumn("__nth", F.row_number().over(own))
            .join(starts, ["__block", "__digit"])
            .select(*rows.columns, *digits[position + 1 :], (F.col("__start") + F.col("__nth") - 1).alias("__at"))
        )
        state = materialize(state)
    return state.select(*rows.columns, (F.col("__at") + 1).alias(rank))


def _prefix_sums(counts: DataFrame) -> DataFrame:
    """(__block, __digit, __start): rows of smaller digits, and of the same digit in earlier blocks.

    Summed per digit, per run of `RUN_BLOCKS` blocks and per block, so that no window sees more than the
    digits, a digit's runs or a run's blocks.
    """

    def before(total: str, order: str, *keys: str) -> Column:
        window = Window.partitionBy(*keys) if keys else Window
        return F.coalesce(F.sum(total).over(window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    single = counts.withColumn("__run", F.floor(F.col("__block") / RUN_BLOCKS))
    runs = single.groupBy("__digit", "__run").agg(F.sum("rows").alias("__rows"))
    digits = runs.groupBy("__digit").agg(F.sum("__rows").alias("__all")).withColumn("__smaller", before("__all", "__digit"))
    starts = runs.withColumn("__earlier", before("__rows", "__run", "__digit")).join(F.broadcast(digits), "__digit")
    start = F.col("__smaller") + F.col("__earlier") + before("rows", "__block", "__digit", "__run")
    return single.join(starts, ["__digit", "__run"]).select("__block", "__digit", start.alias("__start"))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = (10, 100),
    longest: int = 1,
    buckets: int = 10_000,
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): documents drawn in proportion to their likeness to `target`.

    Features are all runs of 1 to `longest` words, hashed to `buckets`; all texts of both tables are counted.
    A bucket's gain compares its share of the target with its share of the documents, a document's weight is
    the mean gain of its features, and Gumbel noise from a hash of `seed` and doc_id turns the highest scores
    into a draw without replacement. Of the N documents with at least `min_words` words the first
    floor(N * share) get their rank, by score, then smaller doc_id, then fewer features; the others' is NULL.
    `share` is a numerator and denominator, so that the number drawn is exact.

    Only the `buckets` counts of either table go to the driver. NULL and empty texts have no features, weight
    0, and are not drawn. Every row comes back; repeated rows are drawn one by one. NULL ids get one
    hash and come last among equal scores. Other columns are ignored.
    """
    histogram = np.zeros((2, buckets), np.int64)
    for side, table in enumerate((docs, target)):
        for row in bucket_counts(table, buckets, longest).collect():
            histogram[side, row.bucket] = row.features
    scored = materialize(weighed(docs, bucket_gains(*histogram), longest, seed))
    able = F.col("n_words") >= min_words
    part, whole = share
    drawn = part * scored.filter(able).count() // whole
    ranked = radix_ranks(scored.filter(able), [F.bitwise_not("score"), F.col("doc_id"), F.col("n_features")])
    result = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank")
    rest = scored.filter(~able).select(*result, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*result, rank).unionAll(rest)
