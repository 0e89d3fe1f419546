"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from peerlight.operators import assemble, clean, hybrid, peers, skew
from peerlight.registry.tables import Tables


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, "/root/testdata/sf0.001")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_both_percentiles_share_one_shuffle(tables):
    text = plan(peers.add_behavioral_risk_flags(tables.snapshot, method="window"))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"- Window ", text)) == 2


def test_top_k_needs_no_global_sort(tables):
    text = plan(hybrid.get_top_risk_providers(tables.hybrid, 25))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_scoring_shuffles_no_rows(tables):
    text = plan(tables.hybrid)
    assert "hashpartitioning" not in text
    assert "CartesianProduct" not in text
    assert not re.search(r"NestedLoop\w* Build", text)
    assert text.count("BroadcastHashJoin") == 1


def test_assembly_adds_no_shuffle_per_join(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([], "provider_id string, report_year int")
        sides = [
            assemble.aggregate_payments(spark.createDataFrame([], "provider_id string, report_year int, payment_amount double")),
            assemble.aggregate_drug_data(spark.createDataFrame([], "provider_id string, report_year int, Brnd_Name string, Tot_Clms bigint")),
            assemble.aggregate_recipient_data(spark.createDataFrame([], "provider_id string, report_year int")),
        ]
        text = plan(assemble.join_data(rows, *sides, hot_keys=[]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One per aggregate, one more for the distinct brands, one for the prescriber rows.
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 5


def test_scan_reads_only_the_columns_it_needs(tables):
    text = plan(peers.peer_percentiles(
        tables.snapshot.select("provider_id", *peers.PEER_KEYS, "payment_per_claim"),
        {"p": "payment_per_claim"}, list(peers.PEER_KEYS), "window",
    ))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"provider_id", *peers.PEER_KEYS, "payment_per_claim"}


def test_filters_reach_the_scan(tables):
    assert "PushedFilters: [IsNotNull(report_year), EqualTo(report_year,1998)]" in plan(
        tables.snapshot.filter(F.col("report_year") == 1998)
    )


def test_no_python_workers(tables):
    for df in (tables.hybrid, tables.labeled, hybrid.best_row_per_provider(tables.hybrid)):
        assert not re.search(r"PythonUDF|PythonEval|InPandas|InArrow", plan(df))


def test_large_lookup_is_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(50).select(F.col("id").cast("string").alias("k"))
        lookup = rows.withColumn("v", F.lit(1))
        small = skew.lookup_left_join(rows, lookup, ["k"])
        large = skew.lookup_left_join(rows, lookup, ["k"], max_broadcast_rows=10)
        assert "BroadcastHashJoin" in plan(small)
        assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
        assert small.exceptAll(large).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clean_sources_prune_unused_columns(spark, tmp_path):
    source = spark.range(5).select(
        F.col("id").cast("string").alias("Covered_Recipient_NPI"),
        F.col("id").cast("string").alias("Total_Amount_of_Payment_USDollars"),
        F.lit("text").alias("Note"),
    )
    source.write.parquet(str(tmp_path / "p"))
    text = plan(assemble.aggregate_payments(clean.clean_payments(spark.read.parquet(str(tmp_path / "p")))))
    assert "Note" not in re.search(r"ReadSchema: (.*)", text).group(1)
