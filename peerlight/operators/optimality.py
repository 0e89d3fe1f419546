"""How far a logistic regression is from the optimum of its weighted, penalised loss."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlight.functions import finite_or_zero
from peerlight.names import CLASS_WEIGHT, LABEL
from peerlight.operators.model import LOGISTIC_SETTINGS

_COLUMNS = (
    "total_weight double, mean_loss double, penalty double, primal double, dual double, gap double, "
    "intercept_gradient double, largest_gradient double"
)


def _softplus(margin: Column) -> Column:
    """log(1 + exp(margin)) without overflow."""
    return F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))


def _x_log_x(value: Column) -> Column:
    return F.when(value > 0, value * F.log(value)).otherwise(F.lit(0.0))


def coefficients_of(model: PipelineModel, features: list[str]) -> tuple[dict[str, float], float]:
    """Coefficients per unit of the raw features, and the intercept, of a fitted scaler and logistic regression."""
    scale, fitted = model.stages[-2].std.toArray(), model.stages[-1]
    per_unit = [c / s if s else 0.0 for c, s in zip(fitted.coefficients.toArray(), scale)]
    return dict(zip(features, per_unit)), float(fitted.intercept)


def optimality_certificate(
    rows: DataFrame,
    coefficients: dict[str, float],
    intercept: float,
    label_col: str = LABEL,
    weight_col: str = CLASS_WEIGHT,
    penalty: float = LOGISTIC_SETTINGS["regParam"],
) -> DataFrame:
    """One row that proves how good the coefficients are, whatever found them.

    The loss is the weighted mean of the logistic losses plus `penalty` / 2 times the squared coefficients per
    weighted standard deviation of their feature; the intercept is free. `largest_gradient` is the largest
    absolute entry of its gradient over the intercept and the features, centred and in deviations; zero at the
    optimum. `gap` is `primal` less `dual`, the value of a feasible point of the dual problem: no coefficients
    have a loss below `dual`, so `gap` bounds what is left to gain. The dual point takes the fitted residuals,
    those of one class scaled so that the weighted sum is zero.

    Two aggregates over `rows`: sums of moments and residuals by class, then the dual's entropy. Missing,
    NaN and infinite features count as 0, as in training. Constant features have no part in the penalty or gradient.
    `ValueError` unless both classes occur, weights are positive and the penalty is.
    """
    if not penalty > 0:
        raise ValueError("a certificate needs a positive penalty")
    names = list(coefficients)
    label, weight = F.col("__label"), F.col("__weight")
    values = [F.col(f"__x{i}") for i in range(len(names))]
    known = rows.select(
        F.col(label_col).cast("double").alias("__label"),
        F.col(weight_col).cast("double").alias("__weight"),
        *[finite_or_zero(name).cast("double").alias(f"__x{i}") for i, name in enumerate(names)],
    ).filter(label.isin(0.0, 1.0))
    margin = sum((F.lit(float(coefficients[n])) * x for n, x in zip(names, values)), F.lit(float(intercept)))
    known = known.withColumn("__margin", margin)
    # Residuals keep their digits where a probability is near 0 or 1.
    miss = F.exp(-_softplus(F.when(label == 1.0, F.col("__margin")).otherwise(-F.col("__margin"))))
    known = known.withColumn("__miss", miss)
    positive, miss = label == 1.0, F.col("__miss")

    sums = {"weight": weight, "weight2": weight * weight, "loss": weight * (_softplus(F.col("__margin")) - label * F.col("__margin"))}
    sums |= {"pos": F.when(positive, weight * miss), "neg": F.when(~positive, weight * miss)}
    # Features are measured from their value in some row: sums of large numbers with a small spread lose digits.
    anchor = known.select(*values).first()
    if anchor is None:
        raise ValueError("a certificate needs rows of either class")
    for i, x in enumerate(values):
        off = x - F.lit(float(anchor[i]))
        sums |= {f"pos{i}": F.when(positive, weight * miss * off), f"neg{i}": F.when(~positive, weight * miss * off)}
        sums |= {f"dev{i}": weight * off, f"dev2{i}": weight * off * off}
    s = known.agg(F.min(F.coalesce(weight, F.lit(0.0))).alias("least"), *[F.sum(c).alias(n) for n, c in sums.items()]).first()
    if s.least is None or s.least <= 0 or not s.pos or not s.neg:
        raise ValueError("a certificate needs rows of either class and positive weights")

    total = s.weight
    freedom = total - s.weight2 / total
    spread = [math.sqrt(max(s[f"dev2{i}"] - s[f"dev{i}"] ** 2 / total, 0.0) / freedom) if freedom > 0 else 0.0 for i in range(len(names))]
    per_spread = [coefficients[n] * sd for n, sd in zip(names, spread)]
    penalised = penalty / 2 * math.fsum(b * b for b in per_spread)
    of_intercept = (s.neg - s.pos) / total
    gradient = [
        ((s[f"neg{i}"] - s[f"pos{i}"]) / total - of_intercept * s[f"dev{i}"] / total) / sd + penalty * b
        for i, (sd, b) in enumerate(zip(spread, per_spread))
        if sd
    ]

    # The class with more residual gives way, so that the weighted residuals add up to zero.
    shrink_pos, shrink_neg = min(1.0, s.neg / s.pos), min(1.0, s.pos / s.neg)
    moved = miss * F.when(positive, F.lit(shrink_pos)).otherwise(F.lit(shrink_neg))
    entropy = known.agg(F.sum(weight * (_x_log_x(moved) + _x_log_x(1 - moved)))).first()[0]
    pull = [(shrink_neg * s[f"neg{i}"] - shrink_pos * s[f"pos{i}"]) / (total * sd) for i, sd in enumerate(spread) if sd]
    dual = -entropy / total - math.fsum(v * v for v in pull) / (2 * penalty)
    primal = s.loss / total + penalised
    found = (total, s.loss / total, penalised, primal, dual, primal - dual, of_intercept, max(map(abs, [of_intercept, *gradient])))
    return rows.sparkSession.createDataFrame([tuple(map(float, found))], _COLUMNS)
