import math

import pytest
from pyspark.sql import functions as F

from peerlight.operators import hybrid, report


def test_bands(spark):
    scores = [0.5499, 0.55, 0.75, 0.9, -0.1, 1.2, None, math.nan]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s double")
    found = [r.b for r in rows.select("i", hybrid.risk_band("s").alias("b")).orderBy("i").collect()]
    assert found == ["low", "medium", "high", "critical", "low", "critical", "low", "critical"]


def test_published_blend(spark):
    rows = spark.createDataFrame([(0.9705219316004753, 0.6330676047689533)], "supervised_score double, anomaly_score double")
    row = hybrid.combine_hybrid_scores(rows).first()
    assert row.hybrid_risk_score == pytest.approx(0.8355402008678665, abs=1e-15) and row.hybrid_risk_band == "high"


def test_inputs_are_clamped(spark):
    rows = spark.createDataFrame([(1.7, -0.2), (None, 2.0)], "supervised_score double, anomaly_score double")
    found = [(r.supervised_score, r.anomaly_score, r.hybrid_risk_score) for r in hybrid.combine_hybrid_scores(rows).collect()]
    assert found == [(1.0, 0.0, 0.6), (0.0, 1.0, 0.4)]


@pytest.fixture
def ranked(spark):
    rows = [("b", 2023, 0.9, 0.1), ("a", 2023, 0.9, 0.1), ("a", 2022, 0.9, 0.1), ("c", 2023, 0.9, 0.2), (None, 2023, 1.0, 1.0), ("", 2023, 1.0, 1.0), ("d", 2020, 0.1, 0.1)]
    df = spark.createDataFrame(rows, "provider_id string, report_year int, hybrid_risk_score double, anomaly_score double")
    return df.withColumn("hybrid_risk_band", hybrid.risk_band("hybrid_risk_score"))


def test_ties_are_broken_by_the_grain(ranked):
    top = hybrid.get_top_risk_providers(ranked.filter("provider_id <> ''"), 4, with_year=True).collect()
    assert [(r.provider_id, r.report_year) for r in top] == [("c", 2023), ("a", 2022), ("a", 2023), ("b", 2023)]
    assert "report_year" not in hybrid.get_top_risk_providers(ranked).columns


def test_best_row_per_provider(ranked):
    best = {r.provider_id: r.report_year for r in hybrid.best_row_per_provider(ranked).collect()}
    assert best == {"a": 2022, "b": 2023, "c": 2023, "d": 2020}


def test_review_list_is_ordered_and_deduplicated(ranked):
    assert [r.provider_id for r in report.review_list(ranked, 6).collect()] == ["c", "a", "b"]


def test_compact_table_keeps_existing_columns_in_order(ranked):
    assert hybrid.build_compact_risk_table(ranked).columns == ["provider_id", "hybrid_risk_score", "hybrid_risk_band", "anomaly_score"]


def test_band_summary_omits_absent_bands(ranked):
    assert [(r.hybrid_risk_band, r["count"]) for r in report.band_summary(ranked).collect()] == [("critical", 6), ("low", 1)]


def test_signal_coverage_uses_existing_flags(spark):
    rows = spark.createDataFrame([(1, 0), (1, 1)], "cia_flag int, doj_flag int")
    assert report.signal_coverage(rows).first().asDict() == {"cia_flag": 2, "doj_flag": 1}


def test_class_balance_of_empty_parts(spark):
    rows = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "is_fraud double")
    found = {r.part: r.positive_share for r in report.class_balance(rows, rows.filter(F.lit(False))).collect()}
    assert found == {"train": 0.25, "test": 0.0}
