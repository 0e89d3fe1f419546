"""Blend of model and anomaly scores, risk bands, rankings and the compact table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlight.functions import clamp_unit
from peerlight.names import (
    ANOMALY_SCORE,
    ANOMALY_SHARE,
    COMPACT_COLUMNS,
    HYBRID_BAND,
    HYBRID_SCORE,
    LABEL,
    LOWEST_BAND,
    PEER_STATE,
    PEER_TYPE,
    PROVIDER_ID,
    REPORT_YEAR,
    RISK_BANDS,
    SUPERVISED_SCORE,
    SUPERVISED_SHARE,
)
from peerlight.operators.clean import select_existing


def risk_band(score: Column | str) -> Column:
    """Name of the highest band whose lower edge the score reaches."""
    value = F.col(score) if isinstance(score, str) else score
    cases = reduce(
        lambda so_far, band: so_far.when(value >= band[1], F.lit(band[0])), RISK_BANDS, F
    )
    return cases.otherwise(F.lit(LOWEST_BAND))


def combine_hybrid_scores(
    df: DataFrame, supervised_col: str = SUPERVISED_SCORE, anomaly_col: str = ANOMALY_SCORE
) -> DataFrame:
    """Clamp both scores and add their weighted blend and its band."""
    return (
        df.withColumns(
            {supervised_col: clamp_unit(supervised_col), anomaly_col: clamp_unit(anomaly_col)}
        )
        .withColumn(
            HYBRID_SCORE,
            F.col(supervised_col) * F.lit(SUPERVISED_SHARE) + F.col(anomaly_col) * F.lit(ANOMALY_SHARE),
        )
        .withColumn(HYBRID_BAND, risk_band(HYBRID_SCORE))
    )


def _rank_order(df: DataFrame) -> list[Column]:
    """Riskiest first; the grain breaks ties so that a ranking repeats."""
    ties = [F.col(name).asc() for name in (PROVIDER_ID, REPORT_YEAR) if name in df.columns]
    return [F.col(HYBRID_SCORE).desc(), F.col(ANOMALY_SCORE).desc(), *ties]


def get_top_risk_providers(df: DataFrame, limit: int = 25, with_year: bool = False) -> DataFrame:
    """The `limit` riskiest rows, in order; `with_year` also returns the row's year."""
    wanted = [PROVIDER_ID, HYBRID_SCORE, HYBRID_BAND, ANOMALY_SCORE]
    wanted += [LABEL, SUPERVISED_SCORE, PEER_TYPE, PEER_STATE]
    wanted += [REPORT_YEAR] if with_year else []
    # Sort, limit and projection become one TakeOrderedAndProject: no global sort.
    return select_existing(df.orderBy(*_rank_order(df)).limit(limit), wanted)


def top_anomalies(df: DataFrame, limit: int = 25) -> DataFrame:
    """The `limit` rows with the highest anomaly score, in order."""
    ties = [F.col(name).asc() for name in (PROVIDER_ID, REPORT_YEAR) if name in df.columns]
    return df.orderBy(F.col(ANOMALY_SCORE).desc(), *ties).limit(limit)


def best_row_per_provider(df: DataFrame) -> DataFrame:
    """Each provider's riskiest row; rows without a provider are skipped.

    An aggregate rather than a window: each task keeps one candidate per provider before the
    shuffle, so a provider with many rows costs no more than any other.
    """
    ranking = [F.col(HYBRID_SCORE), F.col(ANOMALY_SCORE)]
    if REPORT_YEAR in df.columns:
        ranking.append(-F.col(REPORT_YEAR))
    named = df.filter(F.coalesce(F.col(PROVIDER_ID), F.lit("")) != "")
    best = named.groupBy(PROVIDER_ID).agg(
        F.max_by(F.struct(*df.columns), F.struct(*ranking)).alias("best")
    )
    return best.select("best.*")


def build_compact_risk_table(df: DataFrame) -> DataFrame:
    """The columns a reviewer needs, those that exist, in a fixed order."""
    return select_existing(df, list(COMPACT_COLUMNS))
