"""Joins and running totals whose tasks stay small when one key holds most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlight.sources.snapshots import materialize

# A lookup of at most this many rows is sent to every executor; a larger one is shuffled.
BROADCAST_ROWS = 100_000
# A key with more than one row in HOT_SHARE is hot, so fewer than HOT_SHARE keys ever are.
HOT_SHARE = 10_000
# ... and only if it is at most this large when written as text.
BROADCAST_BYTES = 64 << 20
# Tasks one hot key is spread over.
SPREAD = 256

_GROUP = "__group"
_COARSE = "__coarse"
_FINE = "__fine"


def _key_text(keys: list[str]) -> Column:
    """The key columns as one string, with NULL kept apart from text."""
    return F.concat_ws(
        "\u0001", *[F.coalesce(F.col(key).cast("string"), F.lit("\u0000")) for key in keys]
    )


def frequent_keys(rows: DataFrame, keys: list[str], share: float = 0.001) -> list[str]:
    """Key texts that carry more than `share` of the rows, of which there are fewer than 1 / `share`.

    One pass over the key columns with a mergeable sketch, so it needs no shuffle of keys. The
    answer only steers how rows are spread over tasks; results do not depend on it.
    """
    most = min(10_000, int(1 / max(share, 1e-4)) + 1)
    sketch = rows.select(_key_text(keys).alias("k")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(k, {most}, {most * 64})").alias("top"),
    )
    row = sketch.first()
    floor = max(share * row["rows"], 1.0)
    return [item["item"] for item in row["top"] or [] if item["count"] > floor]


def salted_left_join(rows: DataFrame, lookup: DataFrame, keys: list[str], hot: list[str]) -> DataFrame:
    """Left join on `keys` where the rows of each hot key are spread over many tasks.

    The lookup has one row per key; its few hot rows are copied once per salt, all others stay
    single. Without hot keys this is a plain left join.
    """
    if not hot:
        return rows.join(lookup, keys, "left")
    salt = "__salt"
    # Equal rows need different salts, so their place counts too; it steers placement only. Rows are written
    # first: a scan numbers them alike in every attempt of a task, rows from a shuffle may come in another order.
    rows = materialize(rows)
    place = F.xxhash64(F.monotonically_increasing_id(), *[F.col(name) for name in rows.columns])
    row_hash = F.pmod(place, F.lit(SPREAD)).cast("int")
    is_hot = _key_text(keys).isin(hot)
    salted_rows = rows.withColumn(salt, F.when(is_hot, row_hash).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    salted_lookup = lookup.withColumn(salt, F.explode(copies))
    return salted_rows.join(salted_lookup, [*keys, salt], "left").drop(salt)


def lookup_left_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join with a computed list of unknown size: broadcast when counted small, else salted."""
    table = materialize(lookup)
    row_bytes = F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0))
    size = table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()
    if size["rows"] <= max_broadcast_rows and size["bytes"] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), keys, "left")
    return salted_left_join(rows, table, keys, frequent_keys(rows, keys))


def weighted_left_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], weight: str
) -> DataFrame:
    """Left join with a lookup that says how many of the rows each of its keys matches.

    Keys heavier than one row in HOT_SHARE are fewer than HOT_SHARE by counting, so they are
    broadcast and their rows leave the shuffle key; everything else is a shuffled join. The
    last key column must be castable from a whole number and no key may be NULL. `weight` is dropped.
    """
    values = [name for name in lookup.columns if name not in keys and name != weight]
    total = lookup.agg(F.sum(weight)).scalar()
    hot = lookup.filter(F.col(weight) * HOT_SHARE > total).select(
        *keys, *[F.col(name).alias(f"__hot_{name}") for name in values], F.lit(True).alias("__hot")
    )
    spread_key = keys[-1]
    # Written first, so that every attempt of a task numbers its rows alike.
    rows = materialize(rows)
    place = F.xxhash64(F.monotonically_increasing_id(), *[F.col(name) for name in rows.columns])
    spread = F.pmod(place, F.lit(1 << 20))
    tagged = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "__spread",
        F.when(F.col("__hot"), spread.cast(rows.schema[spread_key].dataType)).otherwise(F.col(spread_key)),
    )
    cold = lookup.select(
        *[F.col(name).alias(f"__cold_{name}") for name in [*keys, *values]],
    )
    condition = F.col("__hot").isNull() & (F.col("__spread") == F.col(f"__cold_{spread_key}"))
    for key in keys[:-1]:
        condition = condition & (F.col(key) == F.col(f"__cold_{key}"))
    return tagged.join(cold, condition, "left").select(
        *rows.columns,
        *[
            F.when(F.col("__hot"), F.col(f"__hot_{name}")).otherwise(F.col(f"__cold_{name}")).alias(name)
            for name in values
        ],
    )


def _magnitude_buckets(value: Column) -> tuple[Column, Column]:
    """Two whole numbers that order like `value` and split it ever finer.

    Equal coarse numbers mean the same power of two and the same 12 leading bits; equal fine
    numbers mean 20 further bits. What is left under one pair is at most about a million doubles.
    """
    size = F.abs(value)
    infinite = size == F.lit(float("inf"))
    usable = (size > 0) & ~infinite & ~F.isnan(value)
    exponent = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-900))
    scaled = size * F.pow(F.lit(2.0), -exponent) * F.lit(4096.0)
    sign = F.when(value < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    coarse = (
        F.when(F.isnan(value), F.lit(1 << 41))
        .when(infinite, sign * F.lit(1 << 40))
        .when(usable, sign * ((exponent + 1100) * 16384 + F.floor(scaled)))
        .otherwise(F.lit(0))
        .cast("bigint")
    )
    rest = scaled - F.floor(scaled)
    fine = F.when(usable, sign * F.floor(rest * F.lit(float(1 << 20)))).otherwise(F.lit(0)).cast("bigint")
    return coarse, fine


def running_totals(
    counts: DataFrame, groups: list[str], value: str, measures: list[str]
) -> DataFrame:
    """Per group, what each measure sums to over all smaller values, and over the whole group.

    `counts` has one row per (group, value) and no NULL value. Adds `<measure>_below` and
    `<measure>_total`. A plain window would sort a whole group in one task; here values are
    totalled in coarse buckets, fine buckets and single values, and every window sees only the
    bounded number of buckets of one parent. Bucket numbers are a function of the value alone,
    so the result is exact and repeatable.
    """
    number = F.col(value).cast("double")
    coarse, fine = _magnitude_buckets(number)
    group = F.struct(*groups) if groups else F.lit(0)
    single = counts.withColumns({_GROUP: group, _COARSE: coarse, _FINE: fine})

    def summed(frame: DataFrame, keys: list[str]) -> DataFrame:
        return frame.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])

    def before(keys: list[str], order: str):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def offset(measure: str, keys: list[str], order: str) -> Column:
        return F.coalesce(F.sum(measure).over(before(keys, order)), F.lit(0))

    by_fine = summed(single, [_GROUP, _COARSE, _FINE])
    by_coarse = summed(by_fine, [_GROUP, _COARSE])
    whole = Window.partitionBy(_GROUP)
    coarse_offsets = by_coarse.select(
        _GROUP,
        _COARSE,
        *[offset(m, [_GROUP], _COARSE).alias(f"__c_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
    )
    fine_offsets = by_fine.select(
        _GROUP,
        _COARSE,
        _FINE,
        *[offset(m, [_GROUP, _COARSE], _FINE).alias(f"__f_{m}") for m in measures],
    ).join(coarse_offsets, [_GROUP, _COARSE])
    return (
        single.select(
            "*",
            *[offset(m, [_GROUP, _COARSE, _FINE], value).alias(f"__v_{m}") for m in measures],
        )
        .join(fine_offsets, [_GROUP, _COARSE, _FINE])
        .select(
            *counts.columns,
            *[
                (F.col(f"__c_{m}") + F.col(f"__f_{m}") + F.col(f"__v_{m}")).alias(f"{m}_below")
                for m in measures
            ],
            *[F.col(f"{m}_total") for m in measures],
        )
    )
