"""Ratio, log and threshold features of an assembled provider row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlight.functions import ratio_or_zero
from peerlight.names import HIGH_COST_PER_CLAIM, HIGH_PAYMENT
from peerlight.operators.clean import fill_zero

FILLED_COLUMNS = [
    "total_payments",
    "Tot_Clms",
    "Tot_Benes",
    "Tot_Drug_Cst",
    "unique_drugs",
    "total_drug_claims",
    "recipient_interactions",
]


def claims_per_drug() -> Column:
    return F.col("total_drug_claims") / (F.col("unique_drugs") + 1)


def avg_cost_per_claim() -> Column:
    return ratio_or_zero("Tot_Drug_Cst", "Tot_Clms")


def payment_per_claim() -> Column:
    return ratio_or_zero("total_payments", "Tot_Clms")


def claims_per_beneficiary() -> Column:
    return ratio_or_zero("Tot_Clms", "Tot_Benes")


def log_payments() -> Column:
    return F.log1p("total_payments")


def above(value: Column | str, limit: float) -> Column:
    """1 where the value is over the limit, else 0 (also for NULL)."""
    column = F.col(value) if isinstance(value, str) else value
    return F.when(column > limit, 1).otherwise(0)


def build_features(df: DataFrame) -> DataFrame:
    """Zero-fill the inputs and add the seven derived features, in one projection."""
    return fill_zero(df, FILLED_COLUMNS).withColumns(
        {
            "claims_per_drug": claims_per_drug(),
            "avg_cost_per_claim": avg_cost_per_claim(),
            "payment_per_claim": payment_per_claim(),
            "claims_per_beneficiary": claims_per_beneficiary(),
            "log_payments": log_payments(),
            "high_payment_flag": above("total_payments", HIGH_PAYMENT),
            "high_cost_flag": above(avg_cost_per_claim(), HIGH_COST_PER_CLAIM),
        }
    )
