"""Time the batch stages and headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the local threads.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from peerlight.operators.anomaly import build_anomaly_scores
from peerlight.operators.clean import clean_leie
from peerlight.operators.hybrid import combine_hybrid_scores
from peerlight.operators.labels import add_multi_signal_labels, prediction_cohort
from peerlight.operators.model import train_and_evaluate
from peerlight.plans.batch import save_risk_artifacts
from peerlight.plans.featured import reuse_or_build_features
from peerlight.registry import QUERIES
from peerlight.registry.tables import Tables
from peerlight.sources import load_cia_labels, load_doj_labels, load_leie, materialize, save_model
from tests.rawfiles import write_raw_sources

HEADLINE = [
    "payment_totals",
    "drug_totals",
    "featured_dataset",
    "behavioral_risk_flags",
    "behavioral_risk_flags_by_counts",
    "multi_signal_labels",
    "anomaly_scores",
    "top_risk_providers",
    "curve_areas",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("peerlight-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    """Compute every row and column, and throw them away."""
    df.write.format("noop").mode("overwrite").save()


def batch_stages(spark: SparkSession, root: str, out: str, **training) -> tuple[dict, dict]:
    """The stages of a batch run over CSV sources: seconds and row counts."""
    seconds: dict[str, float] = {}

    def timed(name: str, work):
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    def lists():
        leie = clean_leie(load_leie(spark, f"{root}/leie.csv"))
        return leie, load_cia_labels(spark, root), load_doj_labels(spark, root)

    def label(featured, leie, cia, doj):
        # Written out, so that the peer windows and list joins are really computed.
        cohort = materialize(prediction_cohort(add_multi_signal_labels(featured, leie, cia, doj)))
        return cohort, cohort.count()

    def score(results):
        save_model(results["best_model"], f"{out}/best_model")
        hybrid = combine_hybrid_scores(build_anomaly_scores(results["full_scored_df"]))
        return save_risk_artifacts(hybrid, out)[1]

    leie, cia, doj = timed("stage_label_sources", lists)
    featured, features, _ = timed(
        "stage_features", lambda: reuse_or_build_features(spark, root, f"{out}/featured_data")
    )
    cohort, labeled = timed("stage_labels", lambda: label(featured, leie, cia, doj))
    results = timed("stage_training", lambda: train_and_evaluate(cohort, **training))
    scored = timed("stage_risk_scores", lambda: score(results))
    rows = {"features": features, "labeled": labeled, "training": results["balanced_train_rows"], "scored": scored}
    return seconds, rows


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = session(cpus)
    scratch = tempfile.mkdtemp(prefix="peerlight-bench-")

    # Start-up and first compilation are not measured: one small run comes first.
    small = os.path.join(os.path.dirname(folder), "sf0.001")
    write_raw_sources(Tables(spark, small), f"{scratch}/small")
    batch_stages(spark, f"{scratch}/small", f"{scratch}/small_out", names=["logistic_regression"])

    write_raw_sources(Tables(spark, folder), f"{scratch}/raw")
    seconds, rows = batch_stages(spark, f"{scratch}/raw", f"{scratch}/out")
    total = round(sum(seconds.values()), 3)

    for name in HEADLINE:
        start = time.perf_counter()
        consume(QUERIES[name](spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)

    print(
        json.dumps(
            {
                "metric": "whole batch run from CSV",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder),
                "cpus": cpus,
                "rows": rows,
                "feature_rows_per_sec": round(rows["features"] / seconds["stage_features"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
