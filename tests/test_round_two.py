"""Values and shapes that used to be cut: small amounts, nested folders, equal rows, repeated dates."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from peerlight.functions.columns import exact_sum
from peerlight.operators import labels, model, skew
from peerlight.registry.queries import on_grid
from peerlight.sources.loaders import load_payments


def test_grid_keeps_what_is_not_finite_and_what_is_large(spark):
    values = [float("nan"), float("inf"), -float("inf"), 1e13, 1e308, 0.1234567, None]
    rows = on_grid(spark.createDataFrame([(v,) for v in values], "x double")).collect()
    got = [r.x for r in rows]
    assert math.isnan(got[0]) and got[1:6] == [float("inf"), -float("inf"), 1e13, 1e308, 0.123457] and got[6] is None


def test_sums_keep_amounts_finer_than_four_places(spark):
    df = spark.createDataFrame([(0.00001,), (0.00002,), (0.1,), (0.2,)], "x double")
    assert df.agg(exact_sum("x")).first()[0] == pytest.approx(0.30003, abs=1e-12)
    assert spark.createDataFrame([(0.1,), (0.2,)], "x double").agg(exact_sum("x")).first()[0] == 0.3
    assert spark.createDataFrame([(1e25,), (1.5,)], "x double").agg(exact_sum("x")).first()[0] == 1e25


def test_nested_part_files_are_read(spark, tmp_path):
    line = "Covered_Recipient_NPI,Total_Amount_of_Payment_USDollars\n1,5.5\n"
    for part in ("payments_2022.csv/a.csv", "payments_2023.csv/sub/a.csv", "payments_2024.csv/p=1/a.csv"):
        path = tmp_path / part
        path.parent.mkdir(parents=True)
        path.write_text(line)
    years = [r.report_year for r in load_payments(spark, str(tmp_path)).orderBy("report_year").collect()]
    assert years == [2022, 2023, 2024]


def test_equal_rows_of_a_hot_key_are_spread(spark):
    rows = spark.range(20_000, numPartitions=8).select(F.lit("a").alias("k"))
    lookup = spark.createDataFrame([("a", 1)], "k string, v int")
    joined = skew.salted_left_join(rows, lookup, ["k"], ["a"])
    assert joined.count() == 20_000 and joined.filter("v = 1").count() == 20_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        sizes = skew.salted_left_join(rows, lookup, ["k"], ["a"]).groupBy(F.spark_partition_id()).count()
        assert sizes.agg(F.max("count")).first()[0] < 3 * 20_000 / 64
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hundred_equally_hot_keys_are_all_found(spark):
    rows = spark.range(10_000).select((F.col("id") % 100).alias("k"))
    assert len(skew.frequent_keys(rows, ["k"], 0.005)) == 100


def test_several_dates_of_a_provider_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("0000000007", 2022), ("0000000008", 2022)], "provider_id string, report_year int")
    listed = spark.sql("SELECT '7' AS NPI, DATE'2019-01-01' AS x_date UNION ALL SELECT '7', DATE'2023-05-05'")
    rows = labels.add_optional_flag(df, listed, "x", horizon_years=2).orderBy("provider_id").collect()
    assert [(r.provider_id, r.x) for r in rows] == [("0000000007", 1), ("0000000008", 0)]


def test_areas_of_huge_classes_do_not_overflow(spark, monkeypatch):
    monkeypatch.setattr(model, "materialize", lambda counts: counts.withColumns({"pos": F.col("pos") * 4_000_000_000, "neg": F.col("neg") * 4_000_000_000}))
    df = spark.createDataFrame([(0.1, 0.0), (0.9, 1.0)], "score double, label double")
    assert model.curve_areas(df, "score", "label").first().auc_roc == 1.0
