import datetime
import math

import pytest
from pyspark.sql import functions as F

from peerlight.functions import (
    clamp_unit,
    exact_sum,
    finite_or_zero,
    normalize_key,
    number_or_zero,
    parse_flexible_date,
    ratio_or_zero,
    unit_hash,
)


def values(spark, kind, inputs, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [row.y for row in rows.select("i", expression.alias("y")).orderBy("i").collect()]


KEYS = ["123", " 123 ", "1234567890", "1234567890.0", "12345678901", "", None, "abc", "123.0"]


def test_key_without_decimal_strip(spark):
    assert values(spark, "string", KEYS, normalize_key("x", strip_decimal=False)) == [
        "0000000123", "0000000123", "1234567890", "1234567890", "1234567890", "0000000000", None,
        "0000000abc", "00000123.0",
    ]


def test_key_with_decimal_strip(spark):
    found = values(spark, "string", KEYS, normalize_key("x"))
    assert found[3] == "1234567890"
    assert found[-1] == "0000000123"
    assert found[6] is None


def test_dates_in_three_spellings_and_bad_ones(spark):
    inputs = ["20240115", "1/5/2024", "01/05/2024", "2024-01-15", "20241399", "00000000", "", None, "15.01.2024"]
    day, other = datetime.date(2024, 1, 15), datetime.date(2024, 1, 5)
    found = values(spark, "string", inputs, parse_flexible_date("x"))
    assert found == [day, other, other, day, None, None, None, None, None]


ODD = [0.0, -1.0, None, math.nan, math.inf, -math.inf]


def test_number_or_zero_keeps_infinity(spark):
    assert values(spark, "double", ODD, number_or_zero("x")) == [0.0, -1.0, 0.0, 0.0, math.inf, -math.inf]


def test_finite_or_zero(spark):
    assert values(spark, "double", ODD, finite_or_zero("x")) == [0.0, -1.0, 0.0, 0.0, 0.0, 0.0]
    assert values(spark, "string", ["1.5", "abc", None], finite_or_zero("x")) == [1.5, 0.0, 0.0]
    assert values(spark, "boolean", [True, False, None], finite_or_zero("x")) == [1.0, 0.0, 0.0]


def test_clamp(spark):
    found = values(spark, "double", [-0.1, 0.5, 1.2, None, math.nan], clamp_unit("x"))
    assert found == [0.0, 0.5, 1.0, 0.0, 1.0]


def test_ratio_guards_zero_and_null(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r.y for r in rows.select(ratio_or_zero("a", "b").alias("y")).collect()] == [0.5, 0.0, 0.0]


def test_exact_sum_does_not_depend_on_order(spark):
    amounts = [0.1, 0.2, 0.3, 1e9, -1e9, 0.0001] * 50
    rows = spark.createDataFrame([(v,) for v in amounts], "x double")
    results = {rows.repartition(n).agg(exact_sum("x").alias("y")).first().y for n in (1, 3, 8)}
    assert results == {30.005}


@pytest.mark.parametrize(
    ("amounts", "expected"),
    [([None, None], None), ([1.0, None], 1.0), ([1.0, math.inf], math.inf), ([1e18, 1.0], 1e18 + 1.0)],
)
def test_exact_sum_edges(spark, amounts, expected):
    rows = spark.createDataFrame([(v,) for v in amounts], "x double")
    assert rows.agg(exact_sum("x").alias("y")).first().y == expected


def test_exact_sum_of_nan_is_nan(spark):
    rows = spark.createDataFrame([(1.0,), (math.nan,)], "x double")
    assert math.isnan(rows.agg(exact_sum("x").alias("y")).first().y)


def test_unit_hash_is_even_and_independent_of_partitions(spark):
    rows = spark.range(20000).select(F.lpad(F.col("id").cast("string"), 10, "0").alias("provider_id"))
    hashed = rows.withColumn("u", unit_hash("provider_id", seed=42))
    assert abs(hashed.filter("u < 0.8").count() / 20000 - 0.8) < 0.01
    again = rows.repartition(5).withColumn("u", unit_hash("provider_id", seed=42))
    assert hashed.exceptAll(again).count() == 0


def test_unit_hash_takes_text_keys(spark):
    rows = spark.createDataFrame([("0000000abc",), ("9999999999",)], "provider_id string")
    assert all(0 <= r.u < 1 for r in rows.select(unit_hash("provider_id").alias("u")).collect())


def test_exact_sum_of_quotients_is_bit_stable(spark):
    """Hundredths of amounts are often an ulp off their own decimal; no order of adding shows it."""
    rows = spark.range(5_000).select((F.col("id") * 7919 % 100_003 / 100 / 100).alias("x"), (F.col("id") % 7).alias("k"))
    results = {
        tuple(sorted(map(tuple, rows.repartition(n, *by).groupBy("k").agg(exact_sum("x")).collect())))
        for n, by in ((1, ()), (5, ()), (8, ("x",)), (3, ("k",)))
    }
    assert len(results) == 1


def test_exact_sum_of_large_and_small(spark):
    rows = spark.createDataFrame([(3e15,), (0.25,), (-3e15,)], "x double")
    assert rows.agg(exact_sum("x").alias("y")).first().y == 0.25
    assert rows.limit(0).agg(exact_sum("x").alias("y")).first().y is None
