"""The whole batch run: features, labels, models, risk scores and artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlight.names import (
    DEFAULT_HORIZON_YEARS,
    DEFAULT_REPORT_YEAR,
    HYBRID_BAND,
    LABEL,
    REPORT_YEAR,
    SIGNAL_FLAGS,
)
from peerlight.operators.anomaly import build_anomaly_scores
from peerlight.operators.clean import clean_leie
from peerlight.operators.hybrid import (
    build_compact_risk_table,
    combine_hybrid_scores,
    get_top_risk_providers,
)
from peerlight.operators.labels import add_multi_signal_labels, prediction_cohort
from peerlight.operators.model import train_and_evaluate
from peerlight.operators.report import band_summary, metrics_table, review_list
from peerlight.plans.featured import reuse_or_build_features
from peerlight.sources import (
    load_cia_labels,
    load_doj_labels,
    load_leie,
    materialize_counted,
    owned_snapshots,
    save_json,
    save_model,
    snapshot,
    write_csv,
    write_parquet,
)


def save_risk_artifacts(hybrid_df: DataFrame, out: str, top: int = 100) -> tuple[DataFrame, int]:
    """Write the hybrid table, and from its snapshot the band summary, compact table and top list.

    The compact table keeps its partitions; only the bounded top list becomes a single file.
    """
    hybrid, rows = snapshot(hybrid_df, f"{out}/hybrid_risk_scores", partition_by=[REPORT_YEAR])
    save_json(
        band_summary(hybrid).select(F.col(HYBRID_BAND).alias("band"), "count"), f"{out}/hybrid_summary"
    )
    write_parquet(build_compact_risk_table(hybrid), f"{out}/compact_risk_scores")
    write_csv(get_top_risk_providers(hybrid, limit=top), f"{out}/top_risk_providers", single_file=True)
    save_json(review_list(hybrid), f"{out}/review_list")
    return hybrid, rows


def label_and_score(
    featured: DataFrame,
    leie: DataFrame,
    cia: DataFrame | None = None,
    doj: DataFrame | None = None,
    report_year: int = DEFAULT_REPORT_YEAR,
    horizon_years: int = DEFAULT_HORIZON_YEARS,
    labels: dict | None = None,
    anomaly: dict | None = None,
    **training,
) -> tuple[DataFrame, DataFrame, dict]:
    """Labelled cohort, hybrid-scored cohort and training results from featured rows.

    The labelled rows are written once: training and scoring read them several times, and neither the
    peer ranks nor the list joins are computed again. One narrow scan of them counts labels, prior
    exclusions and signals; these counts are `results["label_summary"]`. `labels` and `anomaly` are further
    arguments of the labelling and the anomaly scores (peer keys, rank method, intermediates).
    """
    labeled = add_multi_signal_labels(featured, leie, cia, doj, report_year, horizon_years, **(labels or {}))
    flags = [name for name in SIGNAL_FLAGS if name in labeled.columns]
    prior = F.col("excluded_on_or_before_report_year") == 1
    metrics = {
        "rows": F.count(F.lit(1)),
        "positives": F.count_if(F.col(LABEL) == 1),
        "excluded_before": F.count_if(prior),
        "cohort_positives": F.count_if(~prior & (F.col(LABEL) == 1)),
        **{name: F.sum(name).cast("long") for name in flags},
    }
    labeled, seen = materialize_counted(labeled, metrics)
    cohort = prediction_cohort(labeled)
    results = train_and_evaluate(cohort, **training)
    results["label_summary"] = {
        "labeled_rows": seen["rows"],
        "positive_rows": seen["positives"],
        "negative_rows": seen["rows"] - seen["positives"],
        "excluded_before_rows": seen["excluded_before"],
        "cohort_rows": seen["rows"] - seen["excluded_before"],
        "cohort_positive_rows": seen["cohort_positives"],
        **{f"signal_{name}": seen[name] or 0 for name in flags},
    }
    # The statistics pass reads only the anomaly features; scoring happens in the final pass.
    hybrid = combine_hybrid_scores(build_anomaly_scores(results["full_scored_df"], **(anomaly or {})))
    return cohort, hybrid, results


def run(
    spark: SparkSession,
    root: str,
    out: str,
    report_year: int = DEFAULT_REPORT_YEAR,
    horizon_years: int = DEFAULT_HORIZON_YEARS,
    sample_fraction: float = 1.0,
    incremental: bool = False,
    labels: dict | None = None,
    anomaly: dict | None = None,
    **training,
) -> dict:
    """Score the providers in the CSV sources below `root` and write every artifact below `out`.

    `sample_fraction` thins the featured rows; `incremental` computes only the years whose inputs changed since
    the last run; `labels` and `anomaly` are further arguments of those steps, the rest of the training.
    Intermediate tables are removed when the run ends well.
    """
    with owned_snapshots(spark):
        return _run(spark, root, out, report_year, horizon_years, sample_fraction, incremental, labels, anomaly, **training)


def _run(spark, root, out, report_year, horizon_years, sample_fraction, incremental, labels, anomaly, **training) -> dict:
    leie = clean_leie(load_leie(spark, f"{root}/leie.csv"))
    cia, doj = load_cia_labels(spark, root), load_doj_labels(spark, root)
    featured, feature_rows, reused = reuse_or_build_features(
        spark, root, f"{out}/featured_data", sample_fraction, incremental
    )
    cohort, hybrid, results = label_and_score(
        featured, leie, cia, doj, report_year, horizon_years, labels, anomaly, **training
    )
    save_model(results["best_model"], f"{out}/best_model")
    metrics = metrics_table(results["metrics_by_model"], spark)
    save_json(metrics.withColumn("selected", F.col("model") == results["best_model_name"]), f"{out}/model_metrics")
    hybrid, hybrid_rows = save_risk_artifacts(hybrid, out)
    summary = {
        "feature_rows": feature_rows,
        "labeled_rows": results["label_summary"]["cohort_rows"],
        "train_rows": results["train_rows"],
        "balanced_train_rows": results["balanced_train_rows"],
        "test_rows": results["test_rows"],
        "hybrid_rows": hybrid_rows,
        "reused_features": reused,
        "best_model_name": results["best_model_name"],
        "feature_columns": results["feature_columns"],
        **{f"training_{name}": value for name, value in results["balance_summary"].items()},
        "sampling_fraction": results["balance_summary"]["sampling_fraction"],
        "sample_fraction": sample_fraction,
    }
    save_json(spark.createDataFrame([results["label_summary"]]), f"{out}/label_summary")
    save_json(spark.createDataFrame([results["balance_summary"]]), f"{out}/balance_summary")
    save_json(spark.createDataFrame([summary]), f"{out}/run_record")
    return {**summary, "metrics_by_model": results["metrics_by_model"]}
