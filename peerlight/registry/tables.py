"""The five logical sources, and the stages built on them, derived from the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlight.functions import normalize_key
from peerlight.names import PEER_GROUP
from peerlight.operators.anomaly import build_anomaly_scores, peer_group_key
from peerlight.operators.assemble import (
    aggregate_drug_data,
    aggregate_payments,
    aggregate_recipient_data,
    join_data,
)
from peerlight.operators.clean import (
    clean_drug_data,
    clean_leie,
    clean_payments,
    clean_prescribers,
    clean_recipient_data,
    sanitize_numbers,
)
from peerlight.operators.features import build_features
from peerlight.operators.hybrid import combine_hybrid_scores
from peerlight.operators.labels import add_multi_signal_labels, prediction_cohort
from peerlight.sources import keep_methods_compilable, materialize

# Line items per task of a shuffle, so that a task's memory does not grow with the table.
TASK_LINES = 500_000
# Below this, a double has digits to spare beyond the cents.
CENTS_BELOW = 1e7
# Weights of the deterministic stand-in for a model score.
STAND_IN_SHIFT = 8.5
STAND_IN_OPIOID = 2


def stand_in_score():
    """Deterministic logistic score used where a query needs scores without a trained model."""
    opioid = F.coalesce(F.col("Opioid_Prscrbr_Rate"), F.lit(0.0))
    linear = F.col("log_payments") - STAND_IN_SHIFT + STAND_IN_OPIOID * opioid / 100
    return 1 / (1 + F.exp(-linear))


def sum_of_cents(name: str) -> Column:
    """Sum of a column's values as decimals(18,2), as double; added as two 64-bit numbers, faster than decimals.

    Where cents / 100 is the very double that was read, its decimal of two places is just these cents.
    """
    value = F.col(name).cast("double")
    near = F.rint(value * 100)
    usual = (F.abs(value) < CENTS_BELOW) & (near / 100 == value)
    cents = F.when(usual, near.cast("long")).otherwise((value.cast("decimal(18,2)") * 100).cast("long"))
    # The low digits and the rest; of either, sums stay in 64 bits for billions of rows.
    high, low = F.sum(F.shiftright(cents, 30)).cast("decimal(20,0)"), F.sum(cents.bitwiseAND(F.lit((1 << 30) - 1)))
    whole = high * F.lit(1 << 30).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    return (whole * F.lit("0.01").cast("decimal(3,2)")).cast("double")


class Tables:
    """Logical sources over one folder of test tables; every stage is a lazy DataFrame.

    An entity is a customer, a year is an order year, and peers share market segment and region.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        keep_methods_compilable(spark)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders").withColumn("y", F.year("o_orderdate"))

    @cached_property
    def line_tasks(self) -> int:
        """Tasks that line items are shuffled to; their number comes from the file's footer."""
        rows = self.read("lineitem").count()
        return max(self.spark.sparkContext.defaultParallelism, -(-rows // TASK_LINES))

    @cached_property
    def lines(self) -> DataFrame:
        order_keys = self.orders.select("o_orderkey", "o_custkey", "y")
        # Shuffled by the join key up front: a file of one row group is one scan task, and the join
        # and the aggregates after it would otherwise run in that task alone. A task's few orders are hashed, which
        # spares sorting its lines.
        lines = self.read("lineitem").repartition(self.line_tasks, "l_orderkey")
        return lines.join(order_keys.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def prescribers(self) -> DataFrame:
        def rate(condition):
            returned = F.sum(F.when(condition, F.col("l_quantity")).otherwise(F.lit(0.0)))
            return 100 * returned / (F.sum("l_quantity") + 50)

        returned = F.col("l_returnflag") == "R"
        discount, price = sum_of_cents("l_discount"), sum_of_cents("l_extendedprice")
        # Lines of no customer match none below. A customer's year is brought together once: its lines would not
        # become fewer by counting suppliers first, and the aggregates need no further shuffle.
        owned = self.lines.filter(F.col("o_custkey").isNotNull()).repartition(self.line_tasks, "o_custkey", "y")
        activity = owned.groupBy("o_custkey", "y").agg(
            F.count(F.lit(1)).alias("Tot_Clms"),
            F.count_distinct("l_suppkey").alias("Tot_Benes"),
            (price / 150).alias("Tot_Drug_Cst"),
            rate(returned).alias("Opioid_Prscrbr_Rate"),
            rate(returned & (F.col("l_linestatus") == "O")).alias("Opioid_LA_Prscrbr_Rate"),
            (1 + 10 * discount / F.count(F.lit(1))).alias("Bene_Avg_Risk_Scre"),
        )
        places = self.read("nation").join(
            self.read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        peers = self.read("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        return (
            self.orders.select("o_custkey", "y")
            .distinct()
            .join(peers, F.col("o_custkey") == F.col("c_custkey"))
            .join(activity, ["o_custkey", "y"], "left")
            .select(
                F.col("o_custkey").cast("string").alias("PRSCRBR_NPI"),
                F.col("y").alias("report_year"),
                F.col("c_mktsegment").alias("Prscrbr_Type"),
                F.col("r_name").alias("Prscrbr_State_Abrvtn"),
                *[name for name in activity.columns if name not in ("o_custkey", "y")],
            )
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.orders.select(
            F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("Covered_Recipient_NPI"),
            (F.col("o_totalprice") / 100).alias("Total_Amount_of_Payment_USDollars"),
            F.col("y").alias("report_year"),
        )

    @cached_property
    def drug(self) -> DataFrame:
        return self.lines.join(
            self.read("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
        ).select(
            F.col("o_custkey").cast("string").alias("Prscrbr_NPI"),
            F.col("p_brand").alias("Brnd_Name"),
            F.col("l_quantity").cast("bigint").alias("Tot_Clms"),
            F.col("y").alias("report_year"),
        )

    @cached_property
    def recipient(self) -> DataFrame:
        return self.read("events").select(
            F.col("user_id").cast("string").alias("Covered_Recipient_NPI"),
            (1995 + F.col("event_id") % 7).cast("int").alias("report_year"),
        )

    @cached_property
    def last_orders(self) -> DataFrame:
        last = self.orders.groupBy("o_custkey").agg(F.max(F.to_date("o_orderdate")).alias("day"))
        return self.read("customer").join(last, F.col("c_custkey") == F.col("o_custkey"))

    @cached_property
    def exclusions(self) -> DataFrame:
        form = F.col("c_custkey") % 3
        text = (
            F.when(form == 0, F.date_format("day", "yyyyMMdd"))
            .when(form == 1, F.date_format("day", "M/d/yyyy"))
            .otherwise(F.date_format("day", "yyyy-MM-dd"))
        )
        return self.last_orders.filter(F.col("c_acctbal") < 0).select(
            F.col("c_custkey").cast("string").alias("EXCLNPI"), text.alias("EXCLDATE")
        )

    @cached_property
    def cia(self) -> DataFrame:
        listed = self.last_orders.filter(F.col("c_acctbal").between(0, 100))
        return listed.select(
            F.col("c_custkey").cast("string").alias("NPI"),
            F.date_format("day", "yyyy-MM-dd").alias("signed"),
        )

    @cached_property
    def doj(self) -> DataFrame:
        listed = self.read("customer").filter(F.col("c_acctbal") > 9880)
        return listed.select(F.col("c_custkey").cast("string").alias("provider_id"))

    @cached_property
    def leie(self) -> DataFrame:
        return clean_leie(self.exclusions)

    @cached_property
    def payment_totals(self) -> DataFrame:
        return aggregate_payments(clean_payments(self.payments))

    @cached_property
    def drug_totals(self) -> DataFrame:
        return aggregate_drug_data(clean_drug_data(self.drug), tasks=self.line_tasks)

    @cached_property
    def recipient_totals(self) -> DataFrame:
        return aggregate_recipient_data(clean_recipient_data(self.recipient))

    def assemble(self, hot_keys: list[str] | None = None) -> DataFrame:
        """Assembled rows; without `hot_keys` they are looked for, as in the batch run."""
        prescribers = clean_prescribers(self.prescribers)
        return join_data(
            materialize(prescribers) if hot_keys is None else prescribers,
            self.payment_totals,
            self.drug_totals,
            self.recipient_totals,
            hot_keys,
        )

    @cached_property
    def featured(self) -> DataFrame:
        # One row per customer and year by construction, so no key can be hot.
        return build_features(self.assemble(hot_keys=[]))

    @cached_property
    def snapshot(self) -> DataFrame:
        """The featured rows written once, for what reads them more than once."""
        return materialize(self.featured)

    @cached_property
    def labeled(self) -> DataFrame:
        return add_multi_signal_labels(self.snapshot, self.leie, self.cia, self.doj)

    @cached_property
    def cohort(self) -> DataFrame:
        return prediction_cohort(self.labeled)

    @cached_property
    def cohort_snapshot(self) -> DataFrame:
        """The cohort written once, for what reads it more than once."""
        return materialize(self.cohort)

    @cached_property
    def scored(self) -> DataFrame:
        return self.cohort.withColumn("supervised_score", stand_in_score())

    @cached_property
    def anomaly(self) -> DataFrame:
        return build_anomaly_scores(self.cohort_snapshot.withColumn("supervised_score", stand_in_score()))

    @cached_property
    def hybrid(self) -> DataFrame:
        return combine_hybrid_scores(self.anomaly)

    def grouped(self, features: list[str]) -> DataFrame:
        """Featured rows with sanitised features and their peer group."""
        return sanitize_numbers(self.featured, features).withColumn(PEER_GROUP, peer_group_key())

    def customer_keys(self) -> DataFrame:
        return self.read("customer").select(normalize_key("c_custkey").alias("provider_id"), "c_acctbal")
