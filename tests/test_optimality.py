import math

import pytest
from pyspark.sql import functions as F

from peerlight.operators import model
from peerlight.operators.optimality import coefficients_of, optimality_certificate

FEATURES = ["a", "b", "c", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    return model.add_class_weight(
        spark.range(800).select(
            n.cast("string").alias("provider_id"),
            (1e6 + (n * 37) % 101).cast("double").alias("a"),
            F.when(n % 17 == 0, None).otherwise((n * n) % 53).alias("b"),
            F.when(n % 13 == 0, float("nan")).otherwise((n % 7) / 3.0).alias("c"),
            F.lit(5.0).alias("same"),
            (((n * 37) % 101 + n % 29) % 4 == 0).cast("double").alias("is_fraud"),
        ),
        200,
        600,
    )


@pytest.fixture(scope="module")
def fitted(rows):
    found = model.train_candidate_models(rows, FEATURES, names=["logistic_regression"])["logistic_regression"]
    return coefficients_of(found, FEATURES)


def test_the_fitted_model_is_optimal(rows, fitted):
    best = optimality_certificate(rows, *fitted).first()
    assert best.largest_gradient < 1e-4
    assert -1e-12 < best.gap < 1e-6


@pytest.mark.parametrize("change", [{"b": 0.02}, {"c": -0.3}, {"b": 0.0, "c": 0.0}])
def test_other_coefficients_are_worse_and_never_below_the_dual(rows, fitted, change):
    best = optimality_certificate(rows, *fitted).first()
    other = optimality_certificate(rows, fitted[0] | change, fitted[1]).first()
    assert other.gap > best.gap + 1e-6 and other.largest_gradient > 1e-4
    assert other.dual <= best.primal <= other.primal
    # The gap bounds what is left to gain.
    assert other.primal - best.primal <= other.gap


def test_values_row_by_row(spark):
    data = [(2.0, 1.0, 3.0), (1.0, 0.0, 1.0), (0.5, 0.0, 2.0), (4.0, 1.0, 1.5)]
    got = optimality_certificate(spark.createDataFrame(data, "x double, is_fraud double, class_weight double"), {"x": 0.7}, -0.2, penalty=0.1).first()
    total = sum(w for *_, w in data)
    mean = sum(w * x for x, _, w in data) / total
    sd = math.sqrt(sum(w * (x - mean) ** 2 for x, _, w in data) / (total - sum(w * w for *_, w in data) / total))
    p = [1 / (1 + math.exp(0.2 - 0.7 * x)) for x, *_ in data]
    loss = -sum(w * math.log(q if y else 1 - q) for (_, y, w), q in zip(data, p)) / total
    slope = sum(w * (q - y) * (x - mean) for (x, y, w), q in zip(data, p)) / (total * sd) + 0.1 * 0.7 * sd
    free = sum(w * (q - y) for (_, y, w), q in zip(data, p)) / total
    assert got.mean_loss == pytest.approx(loss, abs=1e-12) and got.penalty == pytest.approx(0.05 * (0.7 * sd) ** 2, abs=1e-12)
    assert got.intercept_gradient == pytest.approx(free, abs=1e-12)
    assert got.largest_gradient == pytest.approx(max(abs(slope), abs(free)), abs=1e-12)


def test_extreme_margins_stay_finite(spark):
    data = [(1e4, 1.0, 1.0), (-1e4, 0.0, 1.0), (1.0, 0.0, 2.0), (float("inf"), 1.0, 1.0), (None, 0.0, 1.0)]
    rows = spark.createDataFrame(data, "x double, is_fraud double, class_weight double")
    got = optimality_certificate(rows, {"x": 3.0}, 0.5).first()
    assert all(math.isfinite(v) for v in got) and got.gap > 0


@pytest.mark.parametrize(
    "data", [[], [(1.0, 1.0, 1.0)], [(1.0, 1.0, 1.0), (2.0, 0.0, 0.0)], [(1.0, 1.0, None), (2.0, None, 1.0)]]
)
def test_refused(spark, data):
    rows = spark.createDataFrame(data, "x double, is_fraud double, class_weight double")
    with pytest.raises(ValueError):
        optimality_certificate(rows, {"x": 1.0}, 0.0)
    with pytest.raises(ValueError):
        optimality_certificate(rows, {"x": 1.0}, 0.0, penalty=0.0)
