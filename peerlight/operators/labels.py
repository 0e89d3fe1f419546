"""Time-aware exclusion labels and enforcement-list flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlight.functions import normalize_key, parse_flexible_date
from peerlight.names import (
    DEFAULT_HORIZON_YEARS,
    DEFAULT_REPORT_YEAR,
    LABEL,
    PEER_KEYS,
    PLACEHOLDER_KEY,
    PROVIDER_ID,
    REPORT_YEAR,
)
from peerlight.operators.peers import add_behavioral_risk_flags
from peerlight.operators.skew import lookup_left_join
from peerlight.sources.schema import validate_any_column, validate_columns

# Names a list may use for its provider key, in order of preference.
ID_ALIASES = ["provider_id", "NPI", "npi", "Provider_NPI", "provider_npi"]


def _listed(df: DataFrame) -> DataFrame:
    """List rows with a usable key: a padded empty key would match every other one."""
    return df.filter(F.col(PROVIDER_ID) != PLACEHOLDER_KEY)


def prepare_leie_exclusions(leie: DataFrame) -> DataFrame:
    """One row per excluded provider with its earliest readable `exclusion_date`."""
    validate_columns(leie, [PROVIDER_ID, "EXCLDATE"], "leie")
    dated = leie.select(PROVIDER_ID, parse_flexible_date("EXCLDATE").alias("exclusion_date"))
    return _listed(dated).groupBy(PROVIDER_ID).agg(F.min("exclusion_date").alias("exclusion_date"))


def prepare_optional_label_source(
    df: DataFrame, flag_column: str, date_column: str | None = None
) -> DataFrame:
    """One row per listed provider under `provider_id`; `<flag>_date` is its earliest date."""
    source = validate_any_column(df, ID_ALIASES, f"Optional label source for '{flag_column}'")
    key = normalize_key(source).alias(PROVIDER_ID)
    if date_column and date_column in df.columns:
        name = f"{flag_column}_date"
        dated = _listed(df.select(key, parse_flexible_date(date_column).alias(name)))
        return dated.groupBy(PROVIDER_ID).agg(F.min(name).alias(name))
    return _listed(df.select(key)).distinct()


def _year_of(df: DataFrame, report_year: int) -> Column:
    return F.col(REPORT_YEAR) if REPORT_YEAR in df.columns else F.lit(report_year)


def _within_horizon(date: Column, year: Column, horizon_years: int) -> Column:
    """1 where the date lies in the `horizon_years` calendar years after `year`, else 0."""
    first = F.make_date(year + 1, F.lit(1), F.lit(1))
    last = F.make_date(year + horizon_years, F.lit(12), F.lit(31))
    return F.when(date.between(first, last), 1).otherwise(0)


def add_fraud_label(df: DataFrame, leie: DataFrame) -> DataFrame:
    """Static label: `is_fraud` is 1 for every provider on the list, whenever it was excluded."""
    return add_binary_optional_flag(df, leie, LABEL)


def _temporal_labels(df: DataFrame, report_year: int, horizon_years: int) -> DataFrame:
    year = _year_of(df, report_year)
    excluded = F.col("exclusion_date")
    future = _within_horizon(excluded, year, horizon_years)
    return df.withColumns(
        {
            "excluded_on_or_before_report_year": F.when(
                excluded <= F.make_date(year, F.lit(12), F.lit(31)), 1
            ).otherwise(0),
            "is_future_fraud": future,
            LABEL: future,
        }
    )


def add_temporal_fraud_label(
    df: DataFrame,
    leie: DataFrame,
    report_year: int = DEFAULT_REPORT_YEAR,
    horizon_years: int = DEFAULT_HORIZON_YEARS,
) -> DataFrame:
    """Label each provider-year by an exclusion in the years that follow it.

    Also flags exclusions on or before the year's end, which leave the prediction cohort.
    """
    joined = lookup_left_join(df, prepare_leie_exclusions(leie), [PROVIDER_ID])
    return _temporal_labels(joined, report_year, horizon_years)


def add_binary_optional_flag(df: DataFrame, source_df: DataFrame | None, flag_column: str) -> DataFrame:
    """1 for providers on the list, 0 for others, 0 for all without a list."""
    if source_df is None:
        return df.withColumn(flag_column, F.lit(0))
    listed = prepare_optional_label_source(source_df, flag_column)
    marked = lookup_left_join(
        df.drop(flag_column), listed.withColumn(flag_column, F.lit(1)), [PROVIDER_ID]
    )
    return marked.withColumn(flag_column, F.coalesce(F.col(flag_column), F.lit(0)))


def add_optional_flag(
    df: DataFrame,
    source_df: DataFrame | None,
    flag_column: str,
    report_year: int = DEFAULT_REPORT_YEAR,
    horizon_years: int = DEFAULT_HORIZON_YEARS,
) -> DataFrame:
    """As `add_binary_optional_flag`; a list with `<flag>_date` counts only inside the horizon."""
    date = f"{flag_column}_date"
    if source_df is None or date not in source_df.columns:
        return add_binary_optional_flag(df, source_df, flag_column)
    source = validate_any_column(source_df, ID_ALIASES, f"Optional label source for '{flag_column}'")
    listed = _listed(source_df.select(normalize_key(source).alias(PROVIDER_ID), F.col(date).alias("__date")))
    dates = listed.groupBy(PROVIDER_ID).agg(F.collect_set("__date").alias("__dates"), F.min("__date").alias(date))
    year = _year_of(df, report_year)
    joined = lookup_left_join(df.drop(date), dates, [PROVIDER_ID])
    inside = F.exists("__dates", lambda day: _within_horizon(day, year, horizon_years) == 1)
    return joined.withColumn(flag_column, F.coalesce(inside, F.lit(False)).cast("int")).drop("__dates")


def _list_signals(leie: DataFrame, lists: dict[str, DataFrame]) -> DataFrame:
    """All lists as one lookup: a row per listed provider with its date and its flags."""
    parts = [prepare_leie_exclusions(leie)]
    for flag, source in lists.items():
        parts.append(prepare_optional_label_source(source, flag).withColumn(flag, F.lit(1)))
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    return merged.groupBy(PROVIDER_ID).agg(
        F.min("exclusion_date").alias("exclusion_date"), *[F.max(flag).alias(flag) for flag in lists]
    )


def add_multi_signal_labels(
    df: DataFrame,
    leie_df: DataFrame,
    cia_df: DataFrame | None = None,
    doj_df: DataFrame | None = None,
    report_year: int = DEFAULT_REPORT_YEAR,
    horizon_years: int = DEFAULT_HORIZON_YEARS,
    peer_keys: tuple[str, ...] = PEER_KEYS,
    rank_method: str = "auto",
) -> DataFrame:
    """Exclusion labels, list flags, peer outlier flags and their composites in one step.

    The three lists are merged first, so the wide rows are joined once instead of three times.
    """
    flags = {"cia_flag": cia_df, "doj_flag": doj_df}
    lists = {flag: source for flag, source in flags.items() if source is not None}
    joined = lookup_left_join(df, _list_signals(leie_df, lists), [PROVIDER_ID]).withColumns(
        {flag: F.coalesce(F.col(flag), F.lit(0)) if flag in lists else F.lit(0) for flag in flags}
    )
    labeled = _temporal_labels(joined, report_year, horizon_years)
    flagged = add_behavioral_risk_flags(labeled, peer_keys, rank_method)
    return add_composite_labels(flagged)


def add_composite_labels(df: DataFrame) -> DataFrame:
    """High-confidence, enforcement and strength columns, and the final `is_fraud`."""
    confident = F.when(F.col("is_future_fraud") == 1, 1).otherwise(0)
    enforced = F.when((F.col("cia_flag") == 1) | (F.col("doj_flag") == 1), 1).otherwise(0)
    return df.withColumns(
        {
            "high_confidence_fraud_flag": confident,
            "enforcement_risk_flag": enforced,
            "multi_signal_label_strength": confident + enforced + F.col("behavioral_risk_flag"),
            LABEL: confident,
        }
    )


def prediction_cohort(df: DataFrame) -> DataFrame:
    """Rows of providers that were not already excluded in the row's year."""
    return df.filter(F.col("excluded_on_or_before_report_year") == 0)
