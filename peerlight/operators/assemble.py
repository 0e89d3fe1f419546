"""One row per provider-year: pre-aggregated sources joined to the prescriber rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlight.functions import exact_sum
from peerlight.names import grain_of
from peerlight.operators.clean import fill_zero
from peerlight.operators.skew import frequent_keys, salted_left_join

ACTIVITY_COLUMNS = ["total_payments", "unique_drugs", "total_drug_claims", "recipient_interactions"]


def aggregate_payments(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """`total_payments` per provider (and year, if there is one)."""
    return df.groupBy(*(keys or grain_of(df))).agg(exact_sum("payment_amount").alias("total_payments"))


def aggregate_drug_data(df: DataFrame, keys: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """Distinct brands and total claims per provider (and year).

    Where a provider has few rows per brand, counting per brand before the shuffles hardly makes rows fewer. `tasks` then
    brings each provider's (year's) rows together once, in so many tasks, and the aggregates need no further shuffle.
    """
    keys = keys or grain_of(df)
    return (df.repartition(tasks, *keys) if tasks else df).groupBy(*keys).agg(
        F.count_distinct("Brnd_Name").alias("unique_drugs"),
        F.sum("Tot_Clms").alias("total_drug_claims"),
    )


def aggregate_recipient_data(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Profile rows per provider (and year)."""
    return df.groupBy(*(keys or grain_of(df))).agg(F.count(F.lit(1)).alias("recipient_interactions"))


def join_data(
    prescribers: DataFrame,
    payments_agg: DataFrame,
    drug_agg: DataFrame | None = None,
    recipient_agg: DataFrame | None = None,
    hot_keys: list[str] | None = None,
) -> DataFrame:
    """Left-join the aggregates to the prescriber rows and zero-fill what is missing.

    The aggregates are already partitioned by the key, so no join adds a shuffle of them. A key
    that holds many prescriber rows (a placeholder id, say) is found with one sketch pass over
    the key columns, unless `hot_keys` is given, and its rows are spread over many tasks.
    """
    keys = grain_of(prescribers)
    sides = [side for side in (payments_agg, drug_agg, recipient_agg) if side is not None]
    hot = frequent_keys(prescribers, keys) if hot_keys is None else hot_keys
    if hot:
        # One salted join instead of three: the sides meet first, on their common partitioning.
        sides = [reduce(lambda left, right: left.join(right, keys, "full"), sides)]
    joined = reduce(lambda rows, side: salted_left_join(rows, side, keys, hot), sides, prescribers)
    return fill_zero(joined, ACTIVITY_COLUMNS)
