"""Source cleaning: one key column, typed amounts, no NULL payment keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlight.functions import finite_or_zero, normalize_key, number_or_zero
from peerlight.names import PROVIDER_ID
from peerlight.sources.schema import validate_any_column, validate_columns


def _with_key(df: DataFrame, source: str) -> DataFrame:
    """Put the normalised key in `provider_id` in place of the source's own column."""
    columns = [
        normalize_key(name).alias(PROVIDER_ID) if name == source else F.col(f"`{name}`")
        for name in df.columns
    ]
    return df.select(*columns)


def clean_prescribers(df: DataFrame) -> DataFrame:
    """Prescriber rows keyed by `provider_id`."""
    return _with_key(df, validate_any_column(df, ["PRSCRBR_NPI", "Prscrbr_NPI"], "prescribers"))


def clean_payments(df: DataFrame) -> DataFrame:
    """Payments keyed by `provider_id`, the amount as double, rows without a key dropped."""
    validate_columns(df, ["Covered_Recipient_NPI", "Total_Amount_of_Payment_USDollars"], "payments")
    amount = F.col("Total_Amount_of_Payment_USDollars").try_cast("double").alias("payment_amount")
    keyed = _with_key(df, "Covered_Recipient_NPI")
    others = [F.col(f"`{c}`") for c in keyed.columns if c != "Total_Amount_of_Payment_USDollars"]
    return keyed.select(*others, amount).filter(F.col(PROVIDER_ID).isNotNull())


def clean_leie(df: DataFrame) -> DataFrame:
    """Exclusion rows keyed by `provider_id`, preferring `EXCLNPI` over `NPI`."""
    return _with_key(df, validate_any_column(df, ["EXCLNPI", "NPI"], "leie"))


def clean_drug_data(df: DataFrame) -> DataFrame:
    """Prescriber-by-drug rows keyed by `provider_id`."""
    validate_columns(df, ["Prscrbr_NPI"], "drug_data")
    return _with_key(df, "Prscrbr_NPI")


def clean_recipient_data(df: DataFrame) -> DataFrame:
    """Recipient profile rows keyed by `provider_id`."""
    validate_columns(df, ["Covered_Recipient_NPI"], "recipient_data")
    return _with_key(df, "Covered_Recipient_NPI")


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL as 0 in those of `columns` that exist."""
    return df.fillna(0, subset=[name for name in columns if name in df.columns])


def sanitize_numbers(df: DataFrame, columns: list[str], keep_infinite: bool = False) -> DataFrame:
    """Doubles without NULL or NaN (and without infinities) in those of `columns` that exist."""
    clean = number_or_zero if keep_infinite else finite_or_zero
    return df.withColumns({name: clean(name) for name in columns if name in df.columns})


def select_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of the wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])
