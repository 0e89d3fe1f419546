"""Work of the feature build at size: one shuffle of drug rows, fast exact sums, code that the JIT compiles."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from peerlight.functions import exact_sum
from peerlight.operators.assemble import aggregate_drug_data
from peerlight.registry.tables import Tables
from peerlight.sources import keep_methods_compilable
from peerlight.sources.snapshots import JIT_METHOD_BYTES

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_drug_rows_are_shuffled_once_with_tasks(spark):
    rows = [("a", 2020, "x", 3), ("a", 2020, "x", 4), ("a", 2020, None, 5), ("a", 2021, "y", 1), (None, 2020, "y", 2), ("b", None, "z", None)]
    drug = spark.createDataFrame(rows, "provider_id string, report_year int, Brnd_Name string, Tot_Clms bigint")
    once = aggregate_drug_data(drug, tasks=3)
    assert once._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(str, once.collect())) == sorted(map(str, aggregate_drug_data(drug).collect()))


def test_sums_of_short_decimals_use_whole_numbers(spark):
    amounts = [0.1, 123.4567, -99999.99999999, 1e-8, 0.0, -0.0, 3.5e-9, 999999.5, 1234567.25, None]
    rows = spark.createDataFrame([(x,) for x in amounts * 50], "x double")
    eighth = Decimal("0.00000001")
    exact = sum(Decimal(repr(x)).quantize(eighth, ROUND_HALF_UP) for x in amounts if x is not None) * 50
    total = rows.agg(exact_sum("x").alias("y"))
    assert total.first().y == float(exact)
    assert "bigint" in total._jdf.queryExecution().analyzed().toString()
    assert math.isinf(rows.union(spark.createDataFrame([(float("inf"),)], "x double")).agg(exact_sum("x")).first()[0])


def test_generated_methods_stay_compilable(spark, tmp_path):
    old = spark.conf.get(LIMIT)
    try:
        spark.conf.unset(LIMIT)
        Tables(spark, str(tmp_path))
        assert int(spark.conf.get(LIMIT)) == JIT_METHOD_BYTES
        spark.conf.set(LIMIT, "12345")
        keep_methods_compilable(spark)
        assert spark.conf.get(LIMIT) == "12345"
    finally:
        spark.conf.set(LIMIT, old)
    assert spark.range(3).agg(F.sum("id")).first()[0] == 3
