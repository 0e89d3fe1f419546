"""Queries of the ingest edge, exact samples and node tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlight.operators import model
from peerlight.operators.exact_sample import exact_sample
from peerlight.operators.optimality import coefficients_of, optimality_certificate
from peerlight.operators.trees import NODE_COLUMNS, score_with_nodes
from peerlight.registry.queries import _TRAIN_SQL, KEY, KEYS, _fresh_path, query
from peerlight.registry.tables import Tables
from peerlight.sources import load_payments, load_prescribers

# File names carry years from 2000 on.
YEAR_SHIFT = 20


def _write_years(rows: DataFrame, root: str, prefix: str) -> None:
    years = [row[0] for row in rows.select("report_year").distinct().collect()]
    for year in years:
        part = rows.filter(F.col("report_year") == year).drop("report_year")
        part.write.options(header=True, escape='"').csv(f"{root}/{prefix}_{year + YEAR_SHIFT}.csv")


@query(
    "prescribers_from_csv",
    f"""SELECT CAST(o_custkey AS VARCHAR) AS PRSCRBR_NPI, report_year + {YEAR_SHIFT} AS report_year, Tot_Clms, Tot_Drug_Cst,
        CASE WHEN report_year % 2 = 0 THEN '*' ELSE CAST(o_custkey % 10 AS VARCHAR) END AS Extra,
        CASE WHEN report_year % 2 = 0 THEN o_custkey % 3 ELSE o_custkey % 3 + 0.5 END AS Wider
        FROM (SELECT DISTINCT o_custkey, y AS report_year FROM dated_orders) LEFT JOIN
        (SELECT o_custkey, y AS report_year, Tot_Clms, Tot_Drug_Cst FROM activity) USING (o_custkey, report_year)""",
    ["Tot_Drug_Cst", "Wider"],
)
def _(t: Tables) -> DataFrame:
    """Yearly files whose extra columns look like numbers in one year and not, or less wide, in the next."""
    key, even = F.col("PRSCRBR_NPI").cast("long"), F.col("report_year") % 2 == 0
    rows = t.prescribers.select(
        "PRSCRBR_NPI",
        "report_year",
        "Tot_Clms",
        "Tot_Drug_Cst",
        F.when(even, "*").otherwise((key % 10).cast("string")).alias("Extra"),
        F.when(even, (key % 3).cast("string")).otherwise((key % 3 + 0.5).cast("string")).alias("Wider"),
    )
    root = _fresh_path(t)
    _write_years(rows, root, "prescribers")
    return load_prescribers(t.spark, root)


@query(
    "payments_from_csv",
    f"""SELECT o_custkey || '.0' AS Covered_Recipient_NPI, o_totalprice / 100 AS Total_Amount_of_Payment_USDollars,
        'for "' || o_orderstatus || '",' || chr(10) || o_orderpriority AS Note, y + {YEAR_SHIFT} AS report_year FROM dated_orders""",
    ["Total_Amount_of_Payment_USDollars"],
)
def _(t: Tables) -> DataFrame:
    """Yearly files with quotes, commas and line breaks within fields, each read by as many tasks as it has ranges."""
    note = F.concat(F.lit('for "'), "o_orderstatus", F.lit('",\n'), "o_orderpriority")
    rows = t.orders.select(
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("Covered_Recipient_NPI"),
        (F.col("o_totalprice") / 100).alias("Total_Amount_of_Payment_USDollars"),
        note.alias("Note"),
        F.col("y").alias("report_year"),
    )
    root = _fresh_path(t)
    _write_years(rows, root, "payments")
    return load_payments(t.spark, root)


_MD5 = "CAST('0x' || substr(md5('42|' || provider_id || '|' || report_year), 1, 15) AS BIGINT)"


@query(
    "exact_sample",
    f"SELECT {KEYS}, is_fraud FROM cohort ORDER BY {_MD5}, {KEYS} LIMIT (SELECT count(*) // 10 FROM cohort)",
)
def _(t: Tables) -> DataFrame:
    rows = t.cohort_snapshot.select(*KEY, "is_fraud")
    return exact_sample(rows, rows.count() // 10, KEY)


@query(
    "balanced_training_rows_exact",
    f"""SELECT {KEYS}, is_fraud FROM {_TRAIN_SQL} WHERE is_fraud = 1 UNION ALL
        (SELECT {KEYS}, is_fraud FROM {_TRAIN_SQL} WHERE is_fraud = 0 ORDER BY {_MD5}, {KEYS}
         LIMIT (SELECT 3 * count(*) FILTER (is_fraud = 1) FROM {_TRAIN_SQL}))""",
)
def _(t: Tables) -> DataFrame:
    train, _test = model.split_train_test(t.cohort_snapshot.select(*KEY, "is_fraud"))
    return model.rebalance_training_data(train, mode="exact")[0]


# A small ensemble over three features, as (tree, weight, node, feature, threshold, left, right, value).
_FOREST = [
    (0, 1.0, 0, 0, 1000.0, 1, 2, 0.0), (0, 1.0, 1, -1, None, -1, -1, 0.1), (0, 1.0, 2, 1, 20.0, 3, 4, 0.0),
    (0, 1.0, 3, -1, None, -1, -1, 0.4), (0, 1.0, 4, -1, None, -1, -1, 0.9),
    (1, 1.0, 0, 2, 10.0, 1, 2, 0.0), (1, 1.0, 1, -1, None, -1, -1, 0.2), (1, 1.0, 2, -1, None, -1, -1, 0.7),
]


@query(
    "tree_table_scores",
    f"""SELECT {KEYS}, (CASE WHEN total_payments <= 1000 THEN 0.1 WHEN Opioid_Prscrbr_Rate <= 20 THEN 0.4 ELSE 0.9 END
        + CASE WHEN Tot_Clms <= 10 THEN 0.2 ELSE 0.7 END) / 2 AS supervised_score
        FROM (SELECT {KEYS}, coalesce(total_payments, 0) AS total_payments, coalesce(Opioid_Prscrbr_Rate, 0) AS Opioid_Prscrbr_Rate,
              coalesce(Tot_Clms, 0) AS Tot_Clms FROM cohort)""",
    ["supervised_score"],
)
def _(t: Tables) -> DataFrame:
    kinds = "tree int, weight double, node int, feature int, threshold double, left int, right int, value double"
    nodes = t.spark.createDataFrame(_FOREST, kinds).select(*NODE_COLUMNS)
    scored = score_with_nodes(t.cohort_snapshot, nodes, ["total_payments", "Opioid_Prscrbr_Rate", "Tot_Clms"], depth=2)
    return scored.select(*KEY, "supervised_score")


# Coefficients the certificate is tried on.
_TRIED = {"total_payments": 0.00002, "Opioid_Prscrbr_Rate": 0.01, "Tot_Clms": -0.03}
_TRIED_INTERCEPT = -0.4
_WEIGHED_SQL = f"""(SELECT CAST(is_fraud AS DOUBLE) AS y, {', '.join(f'coalesce(CAST({n} AS DOUBLE), 0) AS x{i}' for i, n in enumerate(_TRIED))},
    CASE WHEN is_fraud = 1 THEN (SELECT count(*) FILTER (is_fraud = 0) / count(*) FILTER (is_fraud = 1) FROM cohort) ELSE 1.0 END AS w FROM cohort)"""
_SPREAD_SQL = "sqrt(greatest(sum(w * ({x} - m{i}) * ({x} - m{i})), 0) / (max(total) - sum(w * w) / max(total)))"


@query(
    "logistic_certificate",
    f"""WITH rows AS (SELECT *, {_TRIED_INTERCEPT} + {' + '.join(f'({c}) * x{i}' for i, c in enumerate(_TRIED.values()))} AS margin FROM {_WEIGHED_SQL}),
        means AS (SELECT sum(w) AS total, {', '.join(f'sum(w * x{i}) / sum(w) AS m{i}' for i in range(3))} FROM rows),
        spreads AS (SELECT {', '.join(f"{_SPREAD_SQL.format(x=f'x{i}', i=i)} AS s{i}" for i in range(3))} FROM rows, means),
        told AS (SELECT *, 1 / (1 + exp(-margin)) AS p FROM rows),
        sides AS (SELECT sum(w * (1 - p)) FILTER (y = 1) AS pos, sum(w * p) FILTER (y = 0) AS neg FROM told),
        moved AS (SELECT told.*, CASE WHEN y = 1 THEN 1 - (1 - p) * least(1, neg / pos) ELSE p * least(1, pos / neg) END AS q FROM told, sides),
        done AS (SELECT max(total) AS total_weight, sum(w * (ln(1 + exp(margin)) - y * margin)) / max(total) AS mean_loss,
            0.005 * max({' + '.join(f'pow({c} * s{i}, 2)' for i, c in enumerate(_TRIED.values()))}) AS penalty,
            -sum(w * (CASE WHEN q > 0 THEN q * ln(q) ELSE 0 END + CASE WHEN q < 1 THEN (1 - q) * ln(1 - q) ELSE 0 END)) / max(total)
            - ({' + '.join(f'pow(sum(w * (q - y) * (x{i} - m{i})) / max(total * s{i}), 2)' for i in range(3))}) / 0.02 AS dual,
            sum(w * (p - y)) / max(total) AS intercept_gradient,
            greatest(abs(sum(w * (p - y)) / max(total)),
                {', '.join(f'abs(sum(w * (p - y) * (x{i} - m{i})) / max(total * s{i}) + 0.01 * {c} * max(s{i}))' for i, c in enumerate(_TRIED.values()))})
                AS largest_gradient FROM moved, means, spreads)
        SELECT *, mean_loss + penalty AS primal, mean_loss + penalty - dual AS gap FROM done""",
    ["total_weight", "mean_loss", "penalty", "dual", "intercept_gradient", "largest_gradient", "primal", "gap"],
)
def _(t: Tables) -> DataFrame:
    table, _features = model.prepare_modeling_data(t.cohort_snapshot)
    return optimality_certificate(table, _TRIED, _TRIED_INTERCEPT)


_NEWTON_SQL = f"""WITH RECURSIVE rows AS (SELECT y, w, x0 AS x FROM {_WEIGHED_SQL}),
    scale AS (SELECT sum(w) AS total, sqrt((sum(w * x * x) - sum(w * x) * sum(w * x) / sum(w)) / (sum(w) - sum(w * w) / sum(w))) AS sd FROM rows),
    step(i, a, b) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL
        SELECT i + 1, a - (g * hbb - gb * hab) / (haa * hbb - hab * hab), b - (haa * gb - hab * g) / (haa * hbb - hab * hab)
        FROM (SELECT i, a, b, sum(w * (p - y)) / max(total) AS g, sum(w * (p - y) * z) / max(total) + 0.01 * b AS gb,
                     sum(w * p * (1 - p)) / max(total) AS haa, sum(w * p * (1 - p) * z) / max(total) AS hab,
                     sum(w * p * (1 - p) * z * z) / max(total) + 0.01 AS hbb
              FROM (SELECT step.*, y, w, total, x / sd AS z, 1 / (1 + exp(-(a + b * x / sd))) AS p FROM step, rows, scale WHERE i < 12)
              GROUP BY i, a, b))"""


@query(
    "logistic_regression_coefficients",
    f"""{_NEWTON_SQL} SELECT 'total_payments' AS feature, round(1000 * b / sd, 4) AS per_thousand, round(a, 4) AS intercept,
        true AS optimal FROM step, scale WHERE i = 12""",
    ["per_thousand", "intercept"],
)
def _(t: Tables) -> DataFrame:
    """A logistic regression on one feature, fitted by MLlib here and by Newton's method in the twin."""
    table, _features = model.prepare_modeling_data(t.cohort_snapshot)
    fitted = model.train_candidate_models(table, ["total_payments"], names=["logistic_regression"])["logistic_regression"]
    found, intercept = coefficients_of(fitted, ["total_payments"])
    certificate = optimality_certificate(table, found, intercept)
    return certificate.select(
        F.lit("total_payments").alias("feature"),
        F.round(F.lit(1000 * float(found["total_payments"])), 4).alias("per_thousand"),
        F.round(F.lit(intercept), 4).alias("intercept"),
        ((F.col("gap") < 1e-7) & (F.col("largest_gradient") < 1e-4)).alias("optimal"),
    )
