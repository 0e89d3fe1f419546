"""Summary tables behind a risk report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlight.names import ANOMALY_SCORE, HYBRID_BAND, HYBRID_SCORE, LABEL, PROVIDER_ID, SIGNAL_FLAGS
from peerlight.operators.hybrid import best_row_per_provider, get_top_risk_providers


def band_summary(df: DataFrame) -> DataFrame:
    """Rows per risk band in name order; bands without rows are absent."""
    return df.groupBy(HYBRID_BAND).count().orderBy(HYBRID_BAND)


def label_distribution(df: DataFrame, column: str = LABEL) -> DataFrame:
    """Rows per value of a flag."""
    return df.groupBy(column).count()


def signal_coverage(df: DataFrame, flags: tuple[str, ...] = SIGNAL_FLAGS) -> DataFrame:
    """How many rows carry each flag that exists, as one row."""
    return df.agg(*[F.sum(name).alias(name) for name in flags if name in df.columns])


def class_balance(train: DataFrame, test: DataFrame, label_col: str = LABEL) -> DataFrame:
    """Share of positives in the training and the test rows."""

    def share(df: DataFrame, part: str) -> DataFrame:
        pos = F.count_if(F.col(label_col) == 1.0)
        neg = F.count_if(F.col(label_col) == 0.0)
        return df.agg(
            F.lit(part).alias("part"),
            pos.alias("positives"),
            neg.alias("negatives"),
            (pos / F.greatest(pos + neg, F.lit(1))).alias("positive_share"),
        )

    return share(train, "train").unionByName(share(test, "test"))


def review_list(df: DataFrame, limit: int = 25) -> DataFrame:
    """Each provider's best row among the `limit` riskiest rows, riskiest first."""
    best = best_row_per_provider(get_top_risk_providers(df, limit, with_year=True))
    order = [F.col(HYBRID_SCORE).desc(), F.col(ANOMALY_SCORE).desc(), F.col(PROVIDER_ID).asc()]
    return best.orderBy(*order)


def stage_row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Row count of every named stage, as one row."""
    (first, head), *others = stages.items()
    result = head.agg(F.count(F.lit(1)).alias(first))
    return result.withColumns({name: df.agg(F.count(F.lit(1))).scalar() for name, df in others})


def metrics_table(results: dict, spark) -> DataFrame:
    """One row per candidate model with its metrics, in training order."""
    columns = ["auc_pr", "auc_roc", "precision", "recall", "f1", "accuracy", "tp", "fp", "fn", "tn"]
    rows = [
        (position, name, *[float(metrics[c]) for c in columns[:6]], *[int(metrics[c]) for c in columns[6:]])
        for position, (name, metrics) in enumerate(results.items())
    ]
    schema = "position int, model string, " + ", ".join(
        f"`{c}` {'double' if i < 6 else 'bigint'}" for i, c in enumerate(columns)
    )
    return spark.createDataFrame(rows, schema)
