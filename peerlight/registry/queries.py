"""Every operator as a named query over the given tables, with its SQL twin where one exists."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from peerlight.functions import (
    clamp_unit,
    normalize_key,
    number_or_zero,
    parse_flexible_date,
)
from peerlight.names import PEER_GROUP, PEER_KEYS
from peerlight.operators import anomaly, clean, hybrid, labels, model, peers, report, skew
from peerlight.operators.assemble import aggregate_payments
from peerlight.operators.features import build_features
from peerlight.plans.batch import label_and_score, save_risk_artifacts
from peerlight.plans.featured import sample_rows
from peerlight.registry.sql import FEATURES, PEERS, clamp, pad, with_stages
from peerlight.registry.tables import Tables, stand_in_score
from peerlight.sources import (
    has_multiple_years,
    materialize,
    save_model,
    shared_folder,
    union_years,
    year_in_name,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

KEY = ["provider_id", "report_year"]
KEYS = ", ".join(KEY)


def _gridded(value: Column) -> Column:
    scaled = value * 1e6
    # Where scaling leaves the range of doubles there is no digit below the grid.
    return F.when(F.abs(scaled) < float("inf"), F.rint(scaled) / 1e6).otherwise(value)


def on_grid(df: DataFrame) -> DataFrame:
    """Doubles rounded to a 1e-6 grid, so that two engines' last bits compare equal.

    The arithmetic stays in doubles: NaN, infinities and values of any size come through.
    """
    return df.withColumns(
        {
            field.name: _gridded(F.col(field.name))
            for field in df.schema.fields
            if isinstance(field.dataType, DoubleType)
        }
    )


def query(name: str, sql: str | None = None, doubles: list[str] | tuple[str, ...] = ()):
    """Register a function of `Tables` under `name`, and `sql` as its twin."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: on_grid(build(Tables(spark, folder)))
        if sql is not None:
            SQL[name] = with_stages(sql, doubles)
        return build

    return register


def _fresh_path(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/peerlight/{uuid.uuid4().hex}"


# --- sources -----------------------------------------------------------------------------------


@query(
    "union_of_years",
    "SELECT provider_id, CASE WHEN report_year >= 1998 THEN payment_amount END AS payment_amount, "
    "report_year FROM payments",
    ["payment_amount"],
)
def _(t: Tables) -> DataFrame:
    rows = clean.clean_payments(t.payments)
    early = rows.filter(F.col("report_year") < 1998).drop("payment_amount")
    late = rows.filter(F.col("report_year") >= 1998)
    return union_years([early, late]).select("provider_id", "payment_amount", "report_year")


@query(
    "year_from_file_name",
    """SELECT file_name, coalesce(CAST(nullif(regexp_extract(regexp_extract(file_name, '[^/]*$'),
              '20[0-9][0-9]'), '') AS INTEGER), 2023) AS report_year, count(*) AS files
       FROM (SELECT CASE WHEN o_orderstatus = 'O' THEN 'archive_2019/recipient_profile.csv'
                    ELSE 'raw/payments_' || (y + 20) || '.csv' END AS file_name FROM dated_orders)
       GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    dated = F.concat(F.lit("raw/payments_"), (F.col("y") + 20).cast("string"), F.lit(".csv"))
    undated = F.lit("archive_2019/recipient_profile.csv")
    names = t.orders.select(
        F.when(F.col("o_orderstatus") == "O", undated).otherwise(dated).alias("file_name")
    )
    year = F.coalesce(year_in_name("file_name"), F.lit(2023)).alias("report_year")
    return names.groupBy("file_name", year).agg(F.count(F.lit(1)).alias("files"))


@query("multi_year_detection", "SELECT count(DISTINCT y) > 1 AS multi_year FROM dated_orders")
def _(t: Tables) -> DataFrame:
    return has_multiple_years(t.orders.select(F.col("y").alias("report_year")))


@query(
    "snapshot_round_trip",
    f"SELECT {KEYS}, total_payments, unique_drugs, claims_per_drug FROM featured",
    ["total_payments", "claims_per_drug"],
)
def _(t: Tables) -> DataFrame:
    return t.snapshot.select(*KEY, "total_payments", "unique_drugs", "claims_per_drug")


# --- cleaning ----------------------------------------------------------------------------------


@query(
    "plain_key_normalization",
    f"SELECT c_custkey, {pad('c_custkey')} AS short_key, {pad('c_name')} AS long_key, "
    f"{pad('nullif(c_mktsegment, ' + chr(39) + 'BUILDING' + chr(39) + ')')} AS optional_key FROM customer",
)
def _(t: Tables) -> DataFrame:
    optional = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return t.read("customer").select(
        "c_custkey",
        normalize_key(F.concat(F.lit(" "), F.col("c_custkey")), strip_decimal=False).alias("short_key"),
        normalize_key("c_name", strip_decimal=False).alias("long_key"),
        normalize_key(optional, strip_decimal=False).alias("optional_key"),
    )


@query(
    "payment_cleaning",
    "SELECT provider_id, payment_amount, report_year FROM payments",
    ["payment_amount"],
)
def _(t: Tables) -> DataFrame:
    return clean.clean_payments(t.payments).select("provider_id", "payment_amount", "report_year")


@query(
    "amount_cast",
    """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'n/a'
              ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS payment_amount FROM orders""",
    ["payment_amount"],
)
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    raw = t.orders.select(
        "o_orderkey",
        F.lit("1").alias("Covered_Recipient_NPI"),
        text.alias("Total_Amount_of_Payment_USDollars"),
    )
    return clean.clean_payments(raw).select("o_orderkey", "payment_amount")


@query(
    "null_key_filter",
    f"""SELECT {pad('o_custkey')} AS provider_id, count(*) AS n FROM orders
        WHERE o_orderstatus <> 'O' GROUP BY o_custkey""",
)
def _(t: Tables) -> DataFrame:
    key = F.when(F.col("o_orderstatus") != "O", F.col("o_custkey").cast("string"))
    raw = t.orders.select(
        key.alias("Covered_Recipient_NPI"), F.col("o_totalprice").alias("Total_Amount_of_Payment_USDollars")
    )
    return clean.clean_payments(raw).groupBy("provider_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "null_fill",
    f"SELECT {KEYS}, Tot_Clms, Tot_Benes, Tot_Drug_Cst, total_payments FROM filled",
    ["Tot_Drug_Cst", "total_payments"],
)
def _(t: Tables) -> DataFrame:
    columns = ["Tot_Clms", "Tot_Benes", "Tot_Drug_Cst", "total_payments"]
    return clean.fill_zero(t.assemble(hot_keys=[]), columns).select(*KEY, *columns)


def _odd_numbers(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    odd = (
        F.when(kind == "error", F.lit(None))
        .when(kind == "click", F.lit(float("nan")))
        .when(kind == "view", F.lit(float("inf")))
        .when(kind == "purchase", -F.col("value"))
        .otherwise(F.col("value"))
    )
    return t.read("events").select("event_id", odd.cast("double").alias("x"))


_ODD_SQL = """(SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 0.0 WHEN 'click' THEN 0.0
               WHEN 'purchase' THEN -value ELSE value END AS x FROM events)"""


@query(
    "simple_sanitize",
    f"""SELECT event_id, event_type = 'view' AS infinite, CASE WHEN event_type = 'view' THEN 1.0 ELSE x END AS x
        FROM {_ODD_SQL}""",
    ["x"],
)
def _(t: Tables) -> DataFrame:
    kept = _odd_numbers(t).select("event_id", number_or_zero("x").alias("x"))
    infinite = F.abs("x") == float("inf")
    return kept.select("event_id", infinite.alias("infinite"), F.when(infinite, 1.0).otherwise(F.col("x")).alias("x"))


@query(
    "finite_sanitize",
    f"SELECT event_id, CASE WHEN event_type = 'view' THEN 0.0 ELSE x END AS x FROM {_ODD_SQL}",
    ["x"],
)
def _(t: Tables) -> DataFrame:
    return clean.sanitize_numbers(_odd_numbers(t), ["x"])


@query(
    "flexible_dates",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_orderdate AS DATE)
              WHEN '2-HIGH' THEN CAST(o_orderdate AS DATE) WHEN '3-MEDIUM' THEN CAST(o_orderdate AS DATE)
              END AS day FROM orders""",
)
def _(t: Tables) -> DataFrame:
    form, day = F.col("o_orderpriority"), F.col("o_orderdate")
    text = (
        F.when(form == "1-URGENT", F.date_format(day, "yyyyMMdd"))
        .when(form == "2-HIGH", F.date_format(day, "M/d/yyyy"))
        .when(form == "3-MEDIUM", F.date_format(day, "yyyy-MM-dd"))
        .when(form == "4-NOT SPECIFIED", F.concat(F.year(day).cast("string"), F.lit("1399")))
        .otherwise(F.date_format(day, "dd.MM.yyyy"))
    )
    return t.orders.select("o_orderkey", parse_flexible_date(text).alias("day"))


@query("list_source_preparation", "SELECT provider_id, cia_flag_date FROM cia")
def _(t: Tables) -> DataFrame:
    return labels.prepare_optional_label_source(t.cia, "cia_flag", "signed")


@query(
    "clamp_scores",
    f"SELECT l_orderkey, l_linenumber, {clamp('x')} AS x FROM (SELECT l_orderkey, l_linenumber, "
    "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount * 20 - 0.5 END AS x FROM lineitem)",
    ["x"],
)
def _(t: Tables) -> DataFrame:
    x = F.when(F.col("l_returnflag") != "R", F.col("l_discount") * 20 - 0.5)
    return t.read("lineitem").select("l_orderkey", "l_linenumber", clamp_unit(x).alias("x"))


@query("bernoulli_sample")
def _(t: Tables) -> DataFrame:
    return sample_rows(t.assemble(hot_keys=[]), 0.5).select(*KEY)


# --- joins and set operations ------------------------------------------------------------------

ASSEMBLED = [
    "Tot_Clms", "Tot_Benes", "Tot_Drug_Cst", "Prscrbr_Type", "Prscrbr_State_Abrvtn",
    "total_payments", "unique_drugs", "total_drug_claims", "recipient_interactions",
]
_ASSEMBLED_SQL = f"SELECT {KEYS}, {', '.join(ASSEMBLED)} FROM assembled"


@query("feature_assembly", _ASSEMBLED_SQL, ["Tot_Drug_Cst", "total_payments"])
def _(t: Tables) -> DataFrame:
    return t.assemble().select(*KEY, *ASSEMBLED)


@query("feature_assembly_with_hot_keys", _ASSEMBLED_SQL, ["Tot_Drug_Cst", "total_payments"])
def _(t: Tables) -> DataFrame:
    # The keys the sketch would report, with the threshold lowered so that some are reported.
    hot = skew.frequent_keys(clean.clean_payments(t.payments), KEY, share=0.0)
    return t.assemble(hot_keys=hot).select(*KEY, *ASSEMBLED)


@query("exclusion_date_join", f"SELECT {KEYS}, exclusion_date FROM temporal")
def _(t: Tables) -> DataFrame:
    dates = labels.prepare_leie_exclusions(t.leie)
    rows = clean.clean_prescribers(t.prescribers).select(*KEY)
    return skew.lookup_left_join(rows, dates, ["provider_id"]).select(*KEY, "exclusion_date")


@query(
    "static_fraud_label",
    f"""SELECT {KEYS}, CASE WHEN l.provider_id IS NULL THEN 0 ELSE 1 END AS is_fraud
        FROM prescribers LEFT JOIN (SELECT DISTINCT provider_id FROM leie
        WHERE provider_id <> '0000000000') l USING (provider_id)""",
)
def _(t: Tables) -> DataFrame:
    rows = clean.clean_prescribers(t.prescribers).select(*KEY)
    return labels.add_fraud_label(rows, t.leie).select(*KEY, "is_fraud")


@query("distinct_list_ids", "SELECT DISTINCT provider_id FROM leie WHERE provider_id <> '0000000000'")
def _(t: Tables) -> DataFrame:
    return labels.prepare_optional_label_source(t.leie, "is_fraud")


@query("list_flag", f"SELECT {KEYS}, doj_flag FROM listed")
def _(t: Tables) -> DataFrame:
    rows = clean.clean_prescribers(t.prescribers).select(*KEY)
    return labels.add_binary_optional_flag(rows, t.doj, "doj_flag").select(*KEY, "doj_flag")


@query(
    "dated_list_flag",
    f"""SELECT {KEYS}, CASE WHEN cia_flag_date BETWEEN make_date(report_year + 1, 1, 1)
        AND make_date(report_year + 2, 12, 31) THEN 1 ELSE 0 END AS cia_flag
        FROM prescribers LEFT JOIN cia USING (provider_id)""",
)
def _(t: Tables) -> DataFrame:
    rows = clean.clean_prescribers(t.prescribers).select(*KEY)
    listed = labels.prepare_optional_label_source(t.cia, "cia_flag", "signed")
    return labels.add_optional_flag(rows, listed, "cia_flag").select(*KEY, "cia_flag")


_STAT_PARTS = ["total_payments", "payment_per_claim", "Opioid_Prscrbr_Rate"]
_STATS = [f"{n}_peer_{s}" for n in _STAT_PARTS for s in ("mean", "std")]
_PEER_KEY_SQL = "Prscrbr_Type || '::' || Prscrbr_State_Abrvtn"
_PEER_STATS_SQL = f"""SELECT {_PEER_KEY_SQL} AS peer_group, count(*) AS peer_group_count,
    {', '.join(f'avg({n}) AS {n}_peer_mean, stddev_pop({n}) AS {n}_peer_std' for n in _STAT_PARTS)}
    FROM sanitized GROUP BY 1"""
_GLOBAL_STATS_SQL = f"""SELECT
    {', '.join(f'avg({n}) AS {n}_global_mean, stddev_pop({n}) AS {n}_global_std' for n in _STAT_PARTS)}
    FROM sanitized"""
_GLOBALS = [f"{n}_global_{s}" for n in _STAT_PARTS for s in ("mean", "std")]
_PEER_JOIN_SQL = f"""SELECT {KEYS}, p.* FROM sanitized s
    JOIN ({_PEER_STATS_SQL}) p ON p.peer_group = {_PEER_KEY_SQL}"""


@query("peer_statistics_join", _PEER_JOIN_SQL, _STATS)
def _(t: Tables) -> DataFrame:
    rows = materialize(t.grouped(_STAT_PARTS))
    stats = materialize(anomaly.peer_statistics(rows, _STAT_PARTS))
    return anomaly.attach_peer_statistics(rows.select(*KEY, PEER_GROUP), stats)


@query("peer_statistics_join_without_broadcast", _PEER_JOIN_SQL, _STATS)
def _(t: Tables) -> DataFrame:
    rows = materialize(t.grouped(_STAT_PARTS))
    stats = materialize(anomaly.peer_statistics(rows, _STAT_PARTS))
    return anomaly.attach_peer_statistics(rows.select(*KEY, PEER_GROUP), stats, max_broadcast_rows=0)


@query(
    "global_statistics_join",
    f"SELECT {KEYS}, g.* FROM sanitized CROSS JOIN ({_GLOBAL_STATS_SQL}) g",
    _GLOBALS,
)
def _(t: Tables) -> DataFrame:
    rows = t.grouped(_STAT_PARTS)
    totals = anomaly.global_statistics(rows, _STAT_PARTS)
    return anomaly.attach_global_statistics(rows.select(*KEY), totals)


@query(
    "score_attach",
    f"SELECT {KEYS}, is_fraud, supervised_score FROM scored",
    ["supervised_score"],
)
def _(t: Tables) -> DataFrame:
    scores = t.cohort_snapshot.select(*KEY, stand_in_score().alias("supervised_score"))
    return model.attach_scores(t.cohort_snapshot.select(*KEY, "is_fraud"), scores)


@query(
    "earliest_exclusions",
    "SELECT provider_id, exclusion_date FROM exclusion_dates",
)
def _(t: Tables) -> DataFrame:
    return labels.prepare_leie_exclusions(t.leie)


# --- aggregations ------------------------------------------------------------------------------


@query("payment_totals", "SELECT * FROM payment_totals", ["total_payments"])
def _(t: Tables) -> DataFrame:
    return t.payment_totals


@query(
    "payment_totals_without_year",
    """SELECT provider_id, CAST(sum(CAST(payment_amount AS DECIMAL(22,4))) AS DOUBLE) AS total_payments
       FROM payments GROUP BY provider_id""",
    ["total_payments"],
)
def _(t: Tables) -> DataFrame:
    return aggregate_payments(clean.clean_payments(t.payments).drop("report_year"))


@query("drug_totals", "SELECT * FROM drug_totals")
def _(t: Tables) -> DataFrame:
    return t.drug_totals


@query("recipient_totals", "SELECT * FROM recipient_totals")
def _(t: Tables) -> DataFrame:
    return t.recipient_totals


@query("peer_statistics", _PEER_STATS_SQL, _STATS)
def _(t: Tables) -> DataFrame:
    return anomaly.peer_statistics(t.grouped(_STAT_PARTS), _STAT_PARTS)


@query("global_statistics", _GLOBAL_STATS_SQL, _GLOBALS)
def _(t: Tables) -> DataFrame:
    return anomaly.global_statistics(t.grouped(_STAT_PARTS), _STAT_PARTS)


@query("global_statistics_from_peers", _GLOBAL_STATS_SQL, _GLOBALS)
def _(t: Tables) -> DataFrame:
    stats = materialize(anomaly.peer_statistics(t.grouped(_STAT_PARTS), _STAT_PARTS))
    return anomaly.merge_peer_statistics(stats, _STAT_PARTS)


@query("class_counts", "SELECT is_fraud, count(*) AS count FROM cohort GROUP BY is_fraud")
def _(t: Tables) -> DataFrame:
    return model.class_counts(t.cohort)


@query("label_distribution", "SELECT is_fraud, count(*) AS count FROM labeled GROUP BY is_fraud")
def _(t: Tables) -> DataFrame:
    return report.label_distribution(t.labeled)


@query(
    "prior_exclusion_distribution",
    "SELECT excluded_on_or_before_report_year, count(*) AS count FROM labeled GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return report.label_distribution(t.labeled, "excluded_on_or_before_report_year")


_FLAGS = [
    "high_confidence_fraud_flag", "cia_flag", "doj_flag", "opioid_outlier_flag",
    "payment_outlier_flag", "behavioral_risk_flag", "enforcement_risk_flag",
]


@query(
    "signal_coverage",
    f"SELECT {', '.join(f'CAST(sum({flag}) AS BIGINT) AS {flag}' for flag in _FLAGS)} FROM cohort",
)
def _(t: Tables) -> DataFrame:
    return report.signal_coverage(t.cohort)


_PREDICTED_SQL = "(SELECT is_fraud, CASE WHEN supervised_score >= 0.5 THEN 1 ELSE 0 END AS p FROM scored)"
_CONFUSION_SQL = f"""SELECT count(*) FILTER (is_fraud = 1 AND p = 1) AS tp,
    count(*) FILTER (is_fraud = 0 AND p = 0) AS tn, count(*) FILTER (is_fraud = 0 AND p = 1) AS fp,
    count(*) FILTER (is_fraud = 1 AND p = 0) AS fn FROM {_PREDICTED_SQL}"""


def _predicted(t: Tables) -> DataFrame:
    guess = F.when(F.col("supervised_score") >= 0.5, 1.0).otherwise(0.0)
    return t.scored.select(F.col("is_fraud").cast("double").alias("is_fraud"), guess.alias("prediction"))


@query("confusion_counts", _CONFUSION_SQL)
def _(t: Tables) -> DataFrame:
    return model.confusion_counts(_predicted(t))


@query(
    "stage_row_counts",
    """SELECT (SELECT count(*) FROM featured) AS feature_rows, (SELECT count(*) FROM labeled) AS labeled_rows,
              (SELECT count(*) FROM cohort) AS cohort_rows""",
)
def _(t: Tables) -> DataFrame:
    return report.stage_row_counts(
        {"feature_rows": t.snapshot, "labeled_rows": t.labeled, "cohort_rows": t.cohort}
    )


# --- features ----------------------------------------------------------------------------------

_FEATURE_TYPES = {
    "claims_per_drug": True,
    "avg_cost_per_claim": True,
    "payment_per_claim": True,
    "claims_per_beneficiary": True,
    "log_payments": True,
    "high_payment_flag": False,
    "high_cost_flag": False,
}


def _register_feature(name: str, is_double: bool) -> None:
    @query(f"feature_{name}", f"SELECT {KEYS}, {name} FROM featured", [name] if is_double else [])
    def _(t: Tables) -> DataFrame:
        return t.featured.select(*KEY, name)


for _name, _is_double in _FEATURE_TYPES.items():
    _register_feature(_name, _is_double)

_FEATURED = [*ASSEMBLED, *_FEATURE_TYPES]


@query(
    "featured_dataset",
    f"SELECT {KEYS}, {', '.join(_FEATURED)} FROM featured",
    ["Tot_Drug_Cst", "total_payments", *[n for n, double in _FEATURE_TYPES.items() if double]],
)
def _(t: Tables) -> DataFrame:
    return build_features(t.assemble()).select(*KEY, *_FEATURED)


# --- peer ranks, labels and signals ------------------------------------------------------------


def _register_percentile(name: str, out: str, value: str, method: str) -> None:
    @query(name, f"SELECT {KEYS}, {out} FROM ranked", [out])
    def _(t: Tables) -> DataFrame:
        rows = clean.sanitize_numbers(t.snapshot, [value], keep_infinite=True)
        rows = rows.select(*KEY, *PEER_KEYS, value)
        return peers.peer_percentiles(rows, {out: value}, list(PEER_KEYS), method).select(*KEY, out)


for _out, _value in peers.PERCENTILES.items():
    _register_percentile(_out, _out, _value, "auto")
    _register_percentile(f"{_out}_by_counts", _out, _value, "counted")


@query(
    "peer_percentiles_by_year",
    f"""SELECT {KEYS}, percent_rank() OVER (PARTITION BY {PEERS}, report_year ORDER BY Opioid_Prscrbr_Rate)
        AS opioid_peer_percentile FROM sanitized""",
    ["opioid_peer_percentile"],
)
def _(t: Tables) -> DataFrame:
    rows = clean.sanitize_numbers(t.snapshot, peers.BEHAVIOR_INPUTS, keep_infinite=True)
    measures = {"opioid_peer_percentile": "Opioid_Prscrbr_Rate"}
    return peers.peer_percentiles(rows, measures, [*PEER_KEYS, "report_year"]).select(*KEY, *measures)


@query(
    "temporal_labels",
    f"SELECT {KEYS}, exclusion_date, excluded_on_or_before_report_year, is_future_fraud, "
    "is_future_fraud AS is_fraud FROM temporal",
)
def _(t: Tables) -> DataFrame:
    rows = clean.clean_prescribers(t.prescribers).select(*KEY)
    wanted = ["exclusion_date", "excluded_on_or_before_report_year", "is_future_fraud", "is_fraud"]
    return labels.add_temporal_fraud_label(rows, t.leie).select(*KEY, *wanted)


_OUTLIERS = ["opioid_outlier_flag", "payment_outlier_flag"]


@query("outlier_flags", f"SELECT {KEYS}, {', '.join(_OUTLIERS)} FROM outliers")
def _(t: Tables) -> DataFrame:
    return peers.add_behavioral_risk_flags(t.snapshot).select(*KEY, *_OUTLIERS)


_BEHAVIOR = ["opioid_peer_percentile", "payment_peer_percentile", *_OUTLIERS, "behavioral_risk_flag"]
_BEHAVIOR_SQL = f"SELECT {KEYS}, {', '.join(_BEHAVIOR)} FROM behavior"


@query("behavioral_risk_flags", _BEHAVIOR_SQL, list(peers.PERCENTILES))
def _(t: Tables) -> DataFrame:
    return peers.add_behavioral_risk_flags(t.snapshot).select(*KEY, *_BEHAVIOR)


@query("behavioral_risk_flags_by_counts", _BEHAVIOR_SQL, list(peers.PERCENTILES))
def _(t: Tables) -> DataFrame:
    return peers.add_behavioral_risk_flags(t.snapshot, method="counted").select(*KEY, *_BEHAVIOR)


_COMPOSITES = [
    "high_confidence_fraud_flag", "enforcement_risk_flag", "behavioral_risk_flag",
    "multi_signal_label_strength",
]


@query("composite_labels", f"SELECT {KEYS}, {', '.join(_COMPOSITES)} FROM labeled")
def _(t: Tables) -> DataFrame:
    rows = labels.add_temporal_fraud_label(peers.add_behavioral_risk_flags(t.snapshot), t.leie)
    rows = labels.add_binary_optional_flag(rows, t.cia, "cia_flag")
    rows = labels.add_binary_optional_flag(rows, t.doj, "doj_flag")
    return labels.add_composite_labels(rows).select(*KEY, *_COMPOSITES)


_LABELED = [
    "exclusion_date", "excluded_on_or_before_report_year", "is_future_fraud", "cia_flag", "doj_flag",
    *_OUTLIERS, *_COMPOSITES, "is_fraud",
]


@query("multi_signal_labels", f"SELECT {KEYS}, {', '.join(_LABELED)} FROM labeled")
def _(t: Tables) -> DataFrame:
    return t.labeled.select(*KEY, *_LABELED)


@query("prediction_cohort", f"SELECT {KEYS}, is_fraud FROM cohort")
def _(t: Tables) -> DataFrame:
    return t.cohort.select(*KEY, "is_fraud")


@query("positive_class_rows", f"SELECT {KEYS}, total_payments FROM cohort WHERE is_fraud = 1", ["total_payments"])
def _(t: Tables) -> DataFrame:
    return t.cohort.filter(F.col("is_fraud") == 1).select(*KEY, "total_payments")


# --- anomaly and hybrid risk -------------------------------------------------------------------


@query("peer_group_keys", "SELECT peer_group, count(*) AS n FROM anomaly_input GROUP BY peer_group")
def _(t: Tables) -> DataFrame:
    return t.scored.groupBy(anomaly.peer_group_key().alias(PEER_GROUP)).agg(F.count(F.lit(1)).alias("n"))


_PEER_SCORES = [f"{n}_peer_score" for n in FEATURES]
_GLOBAL_SCORES = [f"{n}_global_score" for n in FEATURES]
_COMPONENTS = [f"{n}_anomaly_component" for n in FEATURES]


@query(
    "peer_z_scores", f"SELECT {KEYS}, peer_group_count, {', '.join(_PEER_SCORES)} FROM components", _PEER_SCORES
)
def _(t: Tables) -> DataFrame:
    return t.anomaly.select(*KEY, "peer_group_count", *_PEER_SCORES)


@query("global_z_scores", f"SELECT {KEYS}, {', '.join(_GLOBAL_SCORES)} FROM components", _GLOBAL_SCORES)
def _(t: Tables) -> DataFrame:
    return t.anomaly.select(*KEY, *_GLOBAL_SCORES)


@query("anomaly_components", f"SELECT {KEYS}, {', '.join(_COMPONENTS)} FROM components", _COMPONENTS)
def _(t: Tables) -> DataFrame:
    return t.anomaly.select(*KEY, *_COMPONENTS)


@query(
    "anomaly_scores",
    f"SELECT {KEYS}, anomaly_score, CASE WHEN anomaly_score >= 0.65 THEN 1 ELSE 0 END AS anomaly_flag FROM anomaly",
    ["anomaly_score"],
)
def _(t: Tables) -> DataFrame:
    return t.anomaly.select(*KEY, "anomaly_score", "anomaly_flag")


@query(
    "hybrid_scores",
    f"SELECT {KEYS}, supervised_score, anomaly_score, hybrid_risk_score, hybrid_risk_band FROM banded",
    ["supervised_score", "anomaly_score", "hybrid_risk_score"],
)
def _(t: Tables) -> DataFrame:
    return t.hybrid.select(*KEY, "supervised_score", "anomaly_score", "hybrid_risk_score", "hybrid_risk_band")


@query(
    "risk_bands",
    """SELECT l_orderkey, l_linenumber, CASE WHEN x >= 0.9 THEN 'critical' WHEN x >= 0.75 THEN 'high'
       WHEN x >= 0.55 THEN 'medium' ELSE 'low' END AS band
       FROM (SELECT l_orderkey, l_linenumber, l_quantity / 50 AS x FROM lineitem)""",
)
def _(t: Tables) -> DataFrame:
    band = hybrid.risk_band(F.col("l_quantity") / 50).alias("band")
    return t.read("lineitem").select("l_orderkey", "l_linenumber", band)


_TOP = ["provider_id", "hybrid_risk_score", "hybrid_risk_band", "anomaly_score", "is_fraud",
        "supervised_score", "Prscrbr_Type", "Prscrbr_State_Abrvtn"]
_RISK_DOUBLES = ["hybrid_risk_score", "anomaly_score", "supervised_score"]
_RISK_ORDER = "hybrid_risk_score DESC, anomaly_score DESC, provider_id, report_year"


@query(
    "top_risk_providers",
    f"SELECT {', '.join(_TOP)} FROM banded ORDER BY {_RISK_ORDER} LIMIT 25",
    _RISK_DOUBLES,
)
def _(t: Tables) -> DataFrame:
    return hybrid.get_top_risk_providers(t.hybrid, 25)


_TOP_ANOMALY = [*KEY, *PEER_KEYS, "total_payments", "payment_per_claim", "anomaly_score"]


@query(
    "top_anomalies",
    f"SELECT {', '.join(_TOP_ANOMALY)} FROM anomaly ORDER BY anomaly_score DESC, {KEYS} LIMIT 25",
    ["total_payments", "payment_per_claim", "anomaly_score"],
)
def _(t: Tables) -> DataFrame:
    return hybrid.top_anomalies(t.anomaly, 25).select(*_TOP_ANOMALY)


_BEST = ["provider_id", "report_year", "hybrid_risk_score", "hybrid_risk_band"]


@query(
    "best_row_per_provider",
    f"""SELECT {', '.join(_BEST)} FROM (SELECT *, row_number() OVER (PARTITION BY provider_id
        ORDER BY hybrid_risk_score DESC, anomaly_score DESC, report_year) AS rn FROM banded) WHERE rn = 1""",
    ["hybrid_risk_score"],
)
def _(t: Tables) -> DataFrame:
    return hybrid.best_row_per_provider(t.hybrid.select(*_BEST, "anomaly_score")).drop("anomaly_score")


_COMPACT = [name for name in hybrid.COMPACT_COLUMNS]
_COMPACT_DOUBLES = [
    "hybrid_risk_score", "supervised_score", "anomaly_score", "total_payments", "payment_per_claim",
    "avg_cost_per_claim", "claims_per_beneficiary", "Opioid_Prscrbr_Rate", "recipient_interactions",
]


@query("compact_risk_table", f"SELECT {', '.join(_COMPACT)} FROM banded", _COMPACT_DOUBLES)
def _(t: Tables) -> DataFrame:
    return hybrid.build_compact_risk_table(t.hybrid)


# --- modelling ---------------------------------------------------------------------------------

_MODELED = ["report_year", "Tot_Clms", "Opioid_Prscrbr_Rate", "total_payments", "high_cost_flag"]
_UNIT_HASH = "(((CAST(provider_id AS BIGINT) % 2147483648) * 2654435761 + 42 * CAST(1013904223 AS BIGINT)) % 4294967296) / 4294967296.0"
_SAMPLE_HASH = (
    "(((((CAST(provider_id AS BIGINT) % 2147483648) * 100 + report_year % 100) % 2147483648) * 2246822519"
    " + 42 * CAST(1013904223 AS BIGINT)) % 4294967296) / 4294967296.0"
)
_TRAIN_SQL = f"(SELECT * FROM cohort WHERE {_UNIT_HASH} < 0.8)"


@query(
    "modeling_table",
    f"""SELECT provider_id, {', '.join(f'CAST({n} AS DOUBLE) AS {n}' for n in _MODELED)},
        CAST(is_fraud AS DOUBLE) AS is_fraud, CASE WHEN is_fraud = 1 THEN
        (SELECT count(*) FILTER (is_fraud = 0) / count(*) FILTER (is_fraud = 1) FROM cohort) ELSE 1.0 END
        AS class_weight FROM cohort""",
    [*_MODELED, "is_fraud", "class_weight"],
)
def _(t: Tables) -> DataFrame:
    table, _features = model.prepare_modeling_data(t.cohort_snapshot)
    return table.select("provider_id", *_MODELED, "is_fraud", "class_weight")


@query(
    "train_test_split",
    f"SELECT {KEYS}, is_fraud, CASE WHEN {_UNIT_HASH} < 0.8 THEN 'train' ELSE 'test' END AS part FROM cohort",
)
def _(t: Tables) -> DataFrame:
    rows = t.cohort_snapshot.select(*KEY, "is_fraud")
    train, test = model.split_train_test(rows)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "balanced_training_rows",
    f"""SELECT {KEYS}, is_fraud FROM {_TRAIN_SQL} WHERE is_fraud = 1 OR {_SAMPLE_HASH} <
        (SELECT least(1.0, greatest(3 * p, p) / n) FROM (SELECT count(*) FILTER (is_fraud = 1) AS p,
         count(*) FILTER (is_fraud = 0) AS n FROM {_TRAIN_SQL}))""",
)
def _(t: Tables) -> DataFrame:
    train, _test = model.split_train_test(t.cohort_snapshot.select(*KEY, "is_fraud"))
    return model.rebalance_training_data(train)[0]


@query("random_split_and_sample")
def _(t: Tables) -> DataFrame:
    train, _test = model.split_train_test(t.cohort_snapshot.select(*KEY, "is_fraud"), mode="random")
    return model.rebalance_training_data(train, mode="random")[0]


def _training(t: Tables) -> tuple[DataFrame, list[str]]:
    table, features = model.prepare_modeling_data(t.cohort_snapshot)
    train, _test = model.split_train_test(table)
    balanced, summary = model.rebalance_training_data(train)
    negatives = summary["balanced_rows"] - summary["positive_count"]
    return model.add_class_weight(balanced, summary["positive_count"], negatives), features


_VECTOR = ["Opioid_Prscrbr_Rate", "Tot_Clms", "total_payments"]


def _assembled_vectors(t: Tables, *more) -> DataFrame:
    rows = t.cohort_snapshot.select(*KEY, *_VECTOR)
    stages = [model._sanitizing_stage(_VECTOR), model.vector_assembler(_VECTOR), *more]
    return Pipeline(stages=stages).fit(rows).transform(rows)


@query(
    "feature_vectors",
    f"SELECT {KEYS}, {', '.join(f'CAST({n} AS DOUBLE) AS v{i}' for i, n in enumerate(_VECTOR))} FROM cohort",
    ["v0", "v1", "v2"],
)
def _(t: Tables) -> DataFrame:
    values = vector_to_array(F.col("features"))
    return _assembled_vectors(t).select(*KEY, *[values[i].alias(f"v{i}") for i in range(len(_VECTOR))])


@query(
    "scaled_features",
    f"SELECT {KEYS}, "
    + ", ".join(f"{n} / (SELECT stddev_samp({n}) FROM cohort) AS v{i}" for i, n in enumerate(_VECTOR))
    + " FROM cohort",
    ["v0", "v1", "v2"],
)
def _(t: Tables) -> DataFrame:
    values = vector_to_array(F.col("scaled_features"))
    scaled = _assembled_vectors(t, model.standard_scaler())
    return scaled.select(*KEY, *[values[i].alias(f"v{i}") for i in range(len(_VECTOR))])


def _register_candidate(name: str) -> None:
    @query(f"{name}_scores")
    def _(t: Tables) -> DataFrame:
        rows, features = _training(t)
        fitted = model.train_candidate_models(rows, features, names=[name])[name]
        return model.score_with_model(t.cohort_snapshot, fitted).select(*KEY, "is_fraud", "supervised_score")


for _name in ("logistic_regression", "random_forest", "gbt_classifier"):
    _register_candidate(_name)


@query("saved_model_scores")
def _(t: Tables) -> DataFrame:
    rows, features = _training(t)
    fitted = model.train_candidate_models(rows, features, names=["logistic_regression"])
    path = _fresh_path(t)
    save_model(fitted["logistic_regression"], path)
    return model.load_and_score(t.cohort_snapshot, path).select(*KEY, "is_fraud", "supervised_score")


@query(
    "curve_areas",
    """SELECT sum(CASE WHEN is_fraud = 1 THEN below + same / 2.0 END) / max(p * n) AS auc_roc,
              (SELECT sum(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos) / (tp - pos + fp - neg)
                                  ELSE tp / (tp + fp) END) / 2) / max(p) AS auc_pr
               FROM (SELECT pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p
                     FROM (SELECT supervised_score AS s, count(*) FILTER (is_fraud = 1) AS pos,
                                  count(*) FILTER (is_fraud = 0) AS neg FROM scored GROUP BY 1)
                     WINDOW w AS (ORDER BY s DESC))) AS auc_pr
       FROM (SELECT is_fraud, count(*) FILTER (is_fraud = 0) OVER (ORDER BY supervised_score
                    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                    - count(*) FILTER (is_fraud = 0) OVER (PARTITION BY supervised_score) AS below,
                    count(*) FILTER (is_fraud = 0) OVER (PARTITION BY supervised_score) AS same,
                    count(*) FILTER (is_fraud = 1) OVER () AS p, count(*) FILTER (is_fraud = 0) OVER () AS n
             FROM scored)""",
    ["auc_roc", "auc_pr"],
)
def _(t: Tables) -> DataFrame:
    rows = t.scored.select(F.col("is_fraud").cast("double").alias("is_fraud"), "supervised_score")
    return model.curve_areas(rows, "supervised_score")


@query(
    "confusion_metrics",
    f"""SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
        coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM ({_CONFUSION_SQL})""",
    ["accuracy", "precision", "recall", "f1"],
)
def _(t: Tables) -> DataFrame:
    return model.confusion_rates(model.confusion_counts(_predicted(t)))


_CANDIDATE_SQL = """SELECT CASE o_orderpriority WHEN '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS model,
    CAST(min(y) AS INTEGER) AS position, avg(o_totalprice) / 1e6 AS auc_pr FROM dated_orders GROUP BY 1"""


@query("best_model_choice", f"{_CANDIDATE_SQL} ORDER BY auc_pr DESC, position LIMIT 1", ["auc_pr"])
def _(t: Tables) -> DataFrame:
    merged = F.when(F.col("o_orderpriority") == "5-LOW", "4-NOT SPECIFIED").otherwise(F.col("o_orderpriority"))
    metrics = t.orders.groupBy(merged.alias("model")).agg(
        F.min("y").alias("position"), (F.avg("o_totalprice") / 1e6).alias("auc_pr")
    )
    return model.best_model_name(metrics)


@query("candidate_metrics")
def _(t: Tables) -> DataFrame:
    results = model.train_and_evaluate(t.cohort_snapshot)
    return report.metrics_table(results["metrics_by_model"], t.spark)


@query("train_and_score")
def _(t: Tables) -> DataFrame:
    _cohort, scored, _results = label_and_score(t.snapshot, t.leie, t.cia, t.doj)
    return scored.select(*KEY, "is_fraud", "supervised_score", "anomaly_score", "hybrid_risk_score")


# --- report tables -----------------------------------------------------------------------------


@query(
    "band_summary",
    "SELECT hybrid_risk_band, count(*) AS count FROM banded GROUP BY hybrid_risk_band",
)
def _(t: Tables) -> DataFrame:
    return report.band_summary(t.hybrid)


@query(
    "class_balance",
    f"""SELECT part, count(*) FILTER (is_fraud = 1) AS positives, count(*) FILTER (is_fraud = 0) AS negatives,
        count(*) FILTER (is_fraud = 1) / greatest(count(*), 1) AS positive_share
        FROM (SELECT is_fraud, CASE WHEN {_UNIT_HASH} < 0.8 THEN 'train' ELSE 'test' END AS part FROM cohort)
        GROUP BY part""",
    ["positive_share"],
)
def _(t: Tables) -> DataFrame:
    rows = t.cohort_snapshot.select(*KEY, "is_fraud")
    return report.class_balance(*model.split_train_test(rows))


_REVIEW_SQL = f"""SELECT {', '.join(_TOP)}, report_year FROM (SELECT *, row_number() OVER (PARTITION BY provider_id
    ORDER BY {_RISK_ORDER}) AS rn FROM (SELECT * FROM banded ORDER BY {_RISK_ORDER} LIMIT 25)) WHERE rn = 1"""


@query("review_list", _REVIEW_SQL, _RISK_DOUBLES)
def _(t: Tables) -> DataFrame:
    return report.review_list(t.hybrid)


@query(
    "saved_risk_table",
    f"SELECT {KEYS}, hybrid_risk_score, hybrid_risk_band, anomaly_score FROM banded",
    ["hybrid_risk_score", "anomaly_score"],
)
def _(t: Tables) -> DataFrame:
    saved, _rows = save_risk_artifacts(t.hybrid, _fresh_path(t))
    return saved.select(*KEY, "hybrid_risk_score", "hybrid_risk_band", "anomaly_score")
