"""Peer percentiles and the outlier flags built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlight.names import OUTLIER_PERCENTILE, PEER_KEYS
from peerlight.operators.clean import sanitize_numbers
from peerlight.operators.skew import lookup_left_join, running_totals, weighted_left_join
from peerlight.sources.schema import validate_columns
from peerlight.sources.snapshots import materialize

# A peer group of at most this many rows may be sorted by one task.
WINDOW_ROWS = 1_000_000

BEHAVIOR_INPUTS = [
    "Opioid_Prscrbr_Rate",
    "Opioid_LA_Prscrbr_Rate",
    "payment_per_claim",
    "avg_cost_per_claim",
    "claims_per_beneficiary",
    "total_payments",
]
PERCENTILES = {
    "opioid_peer_percentile": "Opioid_Prscrbr_Rate",
    "payment_peer_percentile": "payment_per_claim",
}


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Row count of the largest group; a narrow aggregate over the key columns."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n").alias("n")).first().n or 0


def window_percent_ranks(df: DataFrame, measures: dict[str, str], peer_keys: list[str]) -> DataFrame:
    """Percent ranks by window functions: one shuffle by peer group, one sort per measure."""
    return df.withColumns(
        {
            out: F.percent_rank().over(Window.partitionBy(*peer_keys).orderBy(F.col(value).cast("double")))
            for out, value in measures.items()
        }
    )


def counted_percent_ranks(df: DataFrame, measures: dict[str, str], peer_keys: list[str]) -> DataFrame:
    """The same percent ranks for peer groups of any size, without a task per group.

    Rows are first reduced to counted value combinations per group. A value's rank is the number
    of rows below it, from bounded running totals, and is joined back by value; combinations that
    hold many rows (no opioids and no payments, say) are broadcast instead of shuffled.
    Counts and ranks are narrow tables used several times, so each is computed once and kept.
    A NULL measure ranks below all values and numbers are compared as doubles, as with windows.
    """
    group, measure, value, absent = "__peers", "__measure", "__value", "__absent"
    columns = list(dict.fromkeys(measures.values()))
    # NULL is no join key, so each measure travels as a mark and a number.
    parts = {name: (f"__absent_{name}", f"__value_{name}") for name in columns}
    marks = {mark: F.col(name).isNull().cast("int") for name, (mark, _) in parts.items()}
    numbers = {number: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name, (_, number) in parts.items()}
    held = [column for part in parts.values() for column in part]
    keyed = df.withColumn(group, F.struct(*peer_keys)).withColumns({**marks, **numbers})
    combos = materialize(keyed.groupBy(group, *held).agg(F.count(F.lit(1)).alias("__n")))

    # All measures go through the running totals together, as values of one long table.
    stacked = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias(measure), F.col(mark).alias(absent), F.col(number).alias(value))
                for name, (mark, number) in parts.items()
            ]
        )
    )
    counts = (
        combos.select(group, "__n", stacked.alias("__one"))
        .groupBy(group, f"__one.{measure}", f"__one.{absent}", f"__one.{value}")
        .agg(F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("__combos"))
    )
    nulls = materialize(counts.filter(F.col(absent) == 1))
    present = running_totals(counts.filter(F.col(absent) == 0).drop(absent), [measure, group], value, ["rows"])
    below_all = nulls.select(measure, group, F.col("rows").alias("__nulls"))
    totals = lookup_left_join(present, below_all, [measure, group])
    first = F.coalesce("__nulls", F.lit(0))
    others = F.col("rows_total") + first - 1
    rank = F.when(others > 0, (F.col("rows_below") + first) / others).otherwise(F.lit(0.0)).alias("__rank")
    none = nulls.select(group, measure, absent, value, "__combos", F.lit(0.0).alias("__rank"))
    ranks = materialize(totals.select(group, measure, F.lit(0).alias(absent), value, "__combos", rank).unionByName(none))

    ranked = combos
    for out, name in measures.items():
        mark, number = parts[name]
        own = ranks.filter(F.col(measure) == name)
        lookup = own.select(group, F.col(absent).alias(mark), F.col(value).alias(number), F.col("__rank").alias(out), "__combos")
        ranked = weighted_left_join(ranked, lookup, [group, mark, number], "__combos")
    lookup = materialize(ranked.select(group, *held, *measures, "__n"))
    return weighted_left_join(keyed, lookup, [group, *held], "__n").drop(group, *held)


def peer_percentiles(
    df: DataFrame, measures: dict[str, str], peer_keys: list[str], method: str = "auto"
) -> DataFrame:
    """Percent rank of each measure inside its peer group, as new columns named by `measures`.

    `auto` measures the largest group first and uses windows only while every group fits a task.
    """
    if method == "auto":
        method = "window" if largest_group(df, peer_keys) <= WINDOW_ROWS else "counted"
    ranks = {"window": window_percent_ranks, "counted": counted_percent_ranks}[method]
    return ranks(df, measures, peer_keys)


def outlier_flag(value: str, percentile: str) -> Column:
    """1 for a positive value in the top percentile of its peers."""
    extreme = (F.col(value) > 0) & (F.col(percentile) >= OUTLIER_PERCENTILE)
    return F.when(extreme, 1).otherwise(0)


def add_outlier_flags(df: DataFrame) -> DataFrame:
    """Opioid and payment outlier flags from percentiles that are already there."""
    return df.withColumns(
        {
            "opioid_outlier_flag": outlier_flag("Opioid_Prscrbr_Rate", "opioid_peer_percentile"),
            "payment_outlier_flag": outlier_flag("payment_per_claim", "payment_peer_percentile"),
        }
    )


def add_behavior_flag(df: DataFrame) -> DataFrame:
    """`behavioral_risk_flag`: 1 where any outlier or threshold flag is set."""
    causes = ["opioid_outlier_flag", "payment_outlier_flag", "high_payment_flag", "high_cost_flag"]
    return df.withColumn(
        "behavioral_risk_flag",
        F.when(F.greatest(*[F.col(cause) for cause in causes]) >= 1, 1).otherwise(0),
    )


def add_behavioral_risk_flags(
    df: DataFrame, peer_keys: tuple[str, ...] = PEER_KEYS, method: str = "auto"
) -> DataFrame:
    """Sanitise the behaviour columns, rank them among peers and flag the extremes.

    `peer_keys` may include the year to rank each year on its own.
    """
    needed = [*peer_keys, *PERCENTILES.values(), "high_payment_flag", "high_cost_flag"]
    validate_columns(df, needed, "behavioral flags")
    clean = sanitize_numbers(df, BEHAVIOR_INPUTS, keep_infinite=True)
    ranked = peer_percentiles(clean, PERCENTILES, list(peer_keys), method)
    return add_behavior_flag(add_outlier_flags(ranked))
