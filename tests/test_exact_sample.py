import pytest
from pyspark.sql import functions as F

from peerlight.operators import model
from peerlight.operators.exact_sample import exact_sample, kth_smallest


def drawn(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_the_same_k_rows_whatever_the_partitioning(spark):
    rows = spark.range(30_000).select(F.col("id").cast("string").alias("provider_id"), (F.col("id") % 5).alias("x"))
    samples = [drawn(exact_sample(rows.repartition(n, *by), 12_345, ["provider_id"])) for n, by in ((1, ()), (7, ()), (5, ("x",)))]
    assert len(samples[0]) == 12_345 and samples[0] == samples[1] == samples[2]
    smaller = drawn(exact_sample(rows, 100, ["provider_id"]))
    assert len(smaller) == 100 and set(smaller) < set(samples[0])
    assert drawn(exact_sample(rows, 100, ["provider_id"], seed=1)) != smaller


def test_edges(spark):
    rows = spark.range(10).select(F.col("id").alias("k"))
    assert exact_sample(rows, 0, ["k"]).count() == 0 and exact_sample(rows, 10, ["k"]).count() == exact_sample(rows, 99, ["k"]).count() == 10
    assert exact_sample(rows.limit(0), 3, ["k"]).count() == 0


def test_hot_keys_and_repeated_rows(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").alias("k"), (F.col("id") % 4).alias("v"))
    for k in (1, 6_000, 7_001, 19_999):
        assert exact_sample(rows, k, ["k"]).count() == k
    one, other = (drawn(exact_sample(rows.repartition(n), 7_001, ["k"])) for n in (2, 9))
    assert one == other


@pytest.mark.parametrize("k", [1, 2, 3, 500, 20_000])
def test_kth_smallest(spark, k):
    values = sorted([(i * 7919) % 100_003 for i in range(19_997)] + [-(2**59), 2**59, 5])
    df = spark.createDataFrame([(v,) for v in values], "x long")
    value, below = kth_smallest(df, "x", k)
    assert value == values[k - 1] and below == sum(v < value for v in values)
    with pytest.raises(ValueError):
        kth_smallest(df, "x", 20_001)


def test_exact_rebalancing(spark):
    rows = spark.range(4_000).select(
        F.col("id").cast("string").alias("provider_id"), F.lit(2020).alias("report_year"), (F.col("id") % 40 == 0).cast("double").alias("is_fraud")
    )
    balanced, summary = model.rebalance_training_data(rows, mode="exact")
    assert balanced.groupBy("is_fraud").count().orderBy("is_fraud").collect() == [(0.0, 300), (1.0, 100)]
    assert summary["balanced_rows"] == 400 and summary["negative_count"] == 3_900
