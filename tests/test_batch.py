import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from peerlight.operators import model
from peerlight.plans.batch import run
from peerlight.plans.featured import reuse_or_build_features
from peerlight.registry.tables import Tables
from tests.rawfiles import YEAR_SHIFT, write_raw_sources

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    write_raw_sources(Tables(spark, SMALL), root)
    return root


@pytest.fixture(scope="module")
def finished(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return out, run(spark, raw, out, names=["logistic_regression"])


def test_every_artifact_is_written(spark, finished):
    out, summary = finished
    hybrid = spark.read.parquet(f"{out}/hybrid_risk_scores")
    assert hybrid.count() == summary["hybrid_rows"] == summary["labeled_rows"]
    assert hybrid.select("provider_id", "report_year").distinct().count() == hybrid.count()
    assert spark.read.parquet(f"{out}/compact_risk_scores").count() == hybrid.count()
    top = spark.read.csv(f"{out}/top_risk_providers", header=True, inferSchema=True)
    assert top.count() == 100 and len(list(Path(out, "top_risk_providers").glob("*.csv"))) == 1
    bands = spark.read.json(f"{out}/hybrid_summary")
    assert bands.agg(F.sum("count")).first()[0] == hybrid.count()
    metrics = spark.read.json(f"{out}/model_metrics")
    assert metrics.filter("selected").first().model == summary["best_model_name"]
    record = spark.read.json(f"{out}/run_record").first()
    assert record.feature_rows == summary["feature_rows"] >= record.labeled_rows
    again = model.load_and_score(hybrid.drop("supervised_score"), f"{out}/best_model")
    assert again.count() == hybrid.count()


def test_features_from_csv_equal_features_from_tables(spark, finished):
    out, _ = finished
    columns = ["provider_id", "total_payments", "unique_drugs", "total_drug_claims", "recipient_interactions", "Tot_Clms", "Tot_Benes"]
    year = (F.col("report_year") + YEAR_SHIFT).cast("int").alias("report_year")
    wanted = Tables(spark, SMALL).featured.select(*columns, year)
    found = spark.read.parquet(f"{out}/featured_data").select(*columns, F.col("report_year").cast("int").alias("report_year"))
    assert wanted.exceptAll(found).count() == 0 and found.exceptAll(wanted).count() == 0


def test_snapshot_is_reused_for_a_single_year_only(spark, raw, finished, tmp_path):
    out, summary = finished
    assert summary["reused_features"] is False
    single = tmp_path / "raw"
    single.mkdir()
    for prefix in ("prescribers", "payments", "prescriber_drug", "recipient_profile"):
        (single / f"{prefix}_2015.csv").symlink_to(Path(raw) / f"{prefix}_2015.csv")
    path = str(tmp_path / "features")
    built, rows, reused = reuse_or_build_features(spark, str(single), path)
    assert not reused and built.count() == rows
    again, rows_again, reused = reuse_or_build_features(spark, str(single), path)
    assert reused and rows_again == rows
    assert reuse_or_build_features(spark, raw, f"{out}/featured_data")[2] is False


def test_json_artifacts_are_plain_json(finished):
    out, _ = finished
    for name in ("hybrid_summary", "model_metrics", "run_record"):
        lines = [line for part in Path(out, name).glob("*.json") for line in part.read_text().splitlines()]
        assert lines and all(json.loads(line) for line in lines)


def test_summaries_of_labels_and_balance(spark, finished):
    out, summary = finished
    labels = spark.read.json(f"{out}/label_summary").first()
    hybrid = spark.read.parquet(f"{out}/hybrid_risk_scores")
    assert labels.cohort_rows == hybrid.count() == labels.labeled_rows - labels.excluded_before_rows
    assert labels.cohort_positive_rows == hybrid.filter("is_fraud = 1").count() <= labels.positive_rows
    assert labels.positive_rows + labels.negative_rows == labels.labeled_rows
    assert labels.signal_cia_flag >= hybrid.agg(F.sum("cia_flag")).first()[0]
    balance = spark.read.json(f"{out}/balance_summary").first()
    assert balance.positive_count + balance.negative_count == summary["train_rows"]
    assert balance.balanced_rows == summary["balanced_train_rows"] and balance.sampling_fraction == summary["sampling_fraction"]
    assert spark.read.json(f"{out}/review_list").count() <= 25


def test_one_aggregate_plans_the_training(spark, finished):
    out, _ = finished
    rows, _ = model.modeling_rows(spark.read.parquet(f"{out}/hybrid_risk_scores"))
    plan = model.training_plan(rows)
    train, test = model.split_train_test(rows)
    sizes = {(r.is_fraud): r["count"] for r in train.groupBy("is_fraud").count().collect()}
    assert sizes == {1.0: plan["train_positives"], 0.0: plan["train_negatives"]}
    table, rest, summary = model.drawn_training_rows(rows, plan)
    balanced, wanted = model.rebalance_training_data(train)
    assert summary == wanted and table.count() == balanced.count() == summary["balanced_rows"]
    assert table.exceptAll(balanced).count() == 0 and rest.exceptAll(test).count() == 0
