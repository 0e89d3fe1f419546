import pytest
from pyspark.sql import functions as F

from peerlight.operators import assemble, clean, skew
from peerlight.operators.features import build_features


@pytest.fixture
def sides(spark):
    payments = spark.createDataFrame(
        [("1.0", 2022, 10.25), ("1", 2022, 0.5), ("2", 2023, None), (None, 2023, 5.0)],
        "Covered_Recipient_NPI string, report_year int, Total_Amount_of_Payment_USDollars double",
    )
    drug = spark.createDataFrame(
        [("1", 2022, "A", 3), ("1", 2022, "A", 4), ("1", 2022, None, 1), ("1", 2023, "B", 2)],
        "Prscrbr_NPI string, report_year int, Brnd_Name string, Tot_Clms bigint",
    )
    recipient = spark.createDataFrame(
        [("1", 2022), ("1", 2022), ("3", 2022)], "Covered_Recipient_NPI string, report_year int"
    )
    return (
        assemble.aggregate_payments(clean.clean_payments(payments)),
        assemble.aggregate_drug_data(clean.clean_drug_data(drug)),
        assemble.aggregate_recipient_data(clean.clean_recipient_data(recipient)),
    )


@pytest.fixture
def prescribers(spark):
    rows = [("1", 2022), ("1", 2023), ("2", 2023), (None, 2023), (None, 2023)] + [("9", 2022)] * 30
    return clean.clean_prescribers(spark.createDataFrame(rows, "PRSCRBR_NPI string, report_year int"))


def test_assembly_fills_and_keeps_every_row(prescribers, sides):
    joined = assemble.join_data(prescribers, *sides)
    assert joined.count() == prescribers.count()
    row = joined.filter("provider_id = '0000000001' AND report_year = 2022").first()
    assert (row.total_payments, row.unique_drugs, row.total_drug_claims, row.recipient_interactions) == (
        10.75, 1, 8, 2,
    )
    other = joined.filter("provider_id = '0000000002'").first()
    assert (other.total_payments, other.unique_drugs, other.recipient_interactions) == (0.0, 0, 0)


@pytest.mark.parametrize("share", [0.0, 0.3])
def test_hot_keys_change_the_plan_but_not_the_result(prescribers, sides, share):
    hot = skew.frequent_keys(prescribers, ["provider_id", "report_year"], share)
    assert hot
    plain = assemble.join_data(prescribers, *sides, hot_keys=[])
    salted = assemble.join_data(prescribers, *sides, hot_keys=hot).select(plain.columns)
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_frequent_keys_finds_the_heavy_one(prescribers):
    assert skew.frequent_keys(prescribers, ["provider_id", "report_year"], 0.5) == ["0000000009\u00012022"]


def test_salting_spreads_a_hot_key(spark):
    rows = spark.range(5000).select(F.lit("hot").alias("k"), "id")
    lookup = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = skew.salted_left_join(rows, lookup, ["k"], ["hot"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.filter("v = 1").count() == 5000
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_optional_sides_may_be_absent(prescribers, sides):
    joined = assemble.join_data(prescribers, sides[0])
    assert "unique_drugs" not in joined.columns and joined.count() == prescribers.count()


def test_without_a_year_the_grain_is_the_provider(spark):
    payments = spark.createDataFrame([("1", 1.0), ("1", 2.0)], "provider_id string, payment_amount double")
    assert assemble.aggregate_payments(payments).columns == ["provider_id", "total_payments"]


def test_features_guard_divisions(spark):
    df = spark.createDataFrame(
        [("a", 10, 2, 6000.0, 20000.0, 1, 9), ("b", None, None, None, None, None, None), ("c", 0, 0, 5.0, -2.0, 0, 0)],
        "provider_id string, Tot_Clms bigint, Tot_Benes bigint, Tot_Drug_Cst double, total_payments double, "
        "unique_drugs bigint, total_drug_claims bigint",
    )
    rows = {r.provider_id: r for r in build_features(df).collect()}
    a, b, c = rows["a"], rows["b"], rows["c"]
    assert (a.claims_per_drug, a.avg_cost_per_claim, a.payment_per_claim, a.claims_per_beneficiary) == (4.5, 600.0, 2000.0, 5.0)
    assert (a.high_payment_flag, a.high_cost_flag) == (1, 1)
    assert (b.claims_per_drug, b.avg_cost_per_claim, b.log_payments, b.high_payment_flag) == (0.0, 0.0, 0.0, 0)
    assert (c.payment_per_claim, c.claims_per_beneficiary, c.log_payments) == (0.0, 0.0, None)


def test_exactly_on_the_threshold_is_not_high(spark):
    df = spark.createDataFrame(
        [(1, 1, 500.0, 10000.0, 0, 0)],
        "Tot_Clms bigint, Tot_Benes bigint, Tot_Drug_Cst double, total_payments double, "
        "unique_drugs bigint, total_drug_claims bigint",
    )
    row = build_features(df).first()
    assert (row.high_payment_flag, row.high_cost_flag) == (0, 0)
