from __future__ import annotations

import random

from pyspark.sql import functions as F

from peerlight.operators import report
from peerlight.registry import QUERIES, tables


def write_star(spark, folder, orders=60):
    """Small tables of the star schema, with orders of no customer and lines of no order."""
    rnd = random.Random(5)
    put = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    put([(0, "AFRICA")], "r_regionkey int, r_name string", "region")
    put([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int", "nation")
    people = [(i, 0, 100.0 * i - 200, "S") for i in range(8)]
    put(people, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string", "customer")
    rows = [(i, None if i % 13 == 0 else i % 7, 10.5 * i, f"199{i % 5 + 2}-03-04 00:00:00") for i in range(orders)]
    made = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, d string")
    made.withColumn("o_orderdate", F.to_timestamp("d")).drop("d").write.parquet(f"{folder}/orders.parquet")
    lines = [
        (rnd.choice([None, *range(orders + 3)]), rnd.randrange(5), rnd.choice([None, 1, 2]), float(rnd.randrange(9)), rnd.randrange(10**6) / 100, 0.05, "R", "O")
        for _ in range(400)
    ]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string"
    put(lines, schema, "lineitem")
    put([(i, f"B{i % 3}") for i in range(5)], "p_partkey long, p_brand string", "part")
    put([(i, i % 7) for i in range(30)], "event_id long, user_id long", "events")


def test_cents_add_up_like_decimals(spark):
    rnd = random.Random(6)
    odd = [None, 0.0, -0.0, 1.005, 2.675, -2.675, 0.125, 1e-9, 123456.789, -0.01, 9_999_999.99, 1e7, 12345678901.235, -9e14, float("nan")]
    rows = [(i % 4, x) for i, x in enumerate(odd * 3)] + [(5, None)]
    rows += [(rnd.randrange(4), round(rnd.uniform(-1e6, 1e6), rnd.randrange(6))) for _ in range(2000)]
    decimals = F.sum(F.col("x").cast("decimal(18,2)")).cast("double")
    got = spark.createDataFrame(rows, "k int, x double").groupBy("k").agg(decimals.alias("old"), tables.sum_of_cents("x").alias("new"))
    assert all(r.old == r.new for r in got.collect()) and got.count() == 5


def test_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch):
    write_star(spark, tmp_path)
    few = QUERIES["drug_totals"](spark, str(tmp_path)).collect()
    monkeypatch.setattr(tables, "TASK_LINES", 20)
    t = tables.Tables(spark, str(tmp_path))
    assert t.line_tasks == 20 and t.lines.rdd.getNumPartitions() >= 20
    assert sorted(map(str, QUERIES["drug_totals"](spark, str(tmp_path)).collect())) == sorted(map(str, few))


def test_stage_counts_read_the_written_features(spark, tmp_path, monkeypatch):
    write_star(spark, tmp_path)
    seen = {}
    counted = report.stage_row_counts
    monkeypatch.setattr(report, "stage_row_counts", lambda stages: counted(seen.setdefault("stages", stages)))
    row = QUERIES["stage_row_counts"](spark, str(tmp_path)).first()
    files = [f for frame in seen["stages"].values() for f in frame.inputFiles()]
    assert not any("lineitem" in f for f in files)
    featured = tables.Tables(spark, str(tmp_path)).featured
    assert row.feature_rows == row.labeled_rows == featured.count() > row.cohort_rows > 0
