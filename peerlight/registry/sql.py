"""The same logical sources and stages as DuckDB SQL, for the side-by-side checks."""

from __future__ import annotations

from peerlight.names import ANOMALY_FEATURES, PEER_KEYS
from peerlight.registry.tables import STAND_IN_OPIOID, STAND_IN_SHIFT

FEATURES = list(ANOMALY_FEATURES)


def pad(column: str) -> str:
    return f"lpad(trim(CAST({column} AS VARCHAR)), 10, '0')"


def clamp(column: str) -> str:
    return f"least(greatest({column}, 0.0), 1.0)"


def peer_score(name: str) -> str:
    spread = f"(CASE WHEN {name}_peer_std <> 0 THEN {name}_peer_std ELSE 1.0 END)"
    z = f"greatest(({name} - {name}_peer_mean) / ({spread} * 4.0), 0.0)"
    return f"CASE WHEN peer_group_count >= 25 THEN {z} ELSE 0.0 END"


def global_score(name: str) -> str:
    spread = f"(CASE WHEN {name}_global_std <> 0 THEN {name}_global_std ELSE 1.0 END)"
    return f"greatest(({name} - {name}_global_mean) / ({spread} * 4.0), 0.0)"


def moments(scope: str) -> str:
    return ", ".join(
        f"avg({name}) AS {name}_{scope}_mean, stddev_pop({name}) AS {name}_{scope}_std"
        for name in FEATURES
    )


def horizon(date: str) -> str:
    return (
        f"CASE WHEN {date} BETWEEN make_date(report_year + 1, 1, 1) "
        f"AND make_date(report_year + 2, 12, 31) THEN 1 ELSE 0 END"
    )


PEERS = ", ".join(PEER_KEYS)
COMPONENTS = [
    f"greatest({clamp(f'{name}_peer_score')}, {clamp(f'{name}_global_score')})" for name in FEATURES
]

# Each stage may use the ones before it; unused ones cost nothing.
STAGES = {
    "dated_orders": "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders",
    "lines": "SELECT l.*, o.o_custkey, o.y FROM lineitem l JOIN dated_orders o ON l_orderkey = o_orderkey",
    "activity": """
        SELECT o_custkey, y, count(*) AS Tot_Clms, count(DISTINCT l_suppkey) AS Tot_Benes,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 150 AS Tot_Drug_Cst,
               100 * sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END)
                   / (sum(l_quantity) + 50) AS Opioid_Prscrbr_Rate,
               100 * sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_quantity ELSE 0.0 END)
                   / (sum(l_quantity) + 50) AS Opioid_LA_Prscrbr_Rate,
               1 + 10 * CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*)
                   AS Bene_Avg_Risk_Scre
        FROM lines GROUP BY o_custkey, y""",
    "prescribers": f"""
        SELECT {pad('e.o_custkey')} AS provider_id, e.y AS report_year, c_mktsegment AS Prscrbr_Type,
               r_name AS Prscrbr_State_Abrvtn, Tot_Clms, Tot_Benes, Tot_Drug_Cst, Opioid_Prscrbr_Rate,
               Opioid_LA_Prscrbr_Rate, Bene_Avg_Risk_Scre
        FROM (SELECT DISTINCT o_custkey, y FROM dated_orders) e
        JOIN customer ON e.o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN activity a ON e.o_custkey = a.o_custkey AND e.y = a.y""",
    "payments": f"""
        SELECT {pad('o_custkey')} AS provider_id, o_totalprice / 100 AS payment_amount, y AS report_year
        FROM dated_orders""",
    "drug": f"""
        SELECT {pad('o_custkey')} AS provider_id, p_brand AS Brnd_Name,
               CAST(l_quantity AS BIGINT) AS Tot_Clms, y AS report_year
        FROM lines JOIN part ON l_partkey = p_partkey""",
    "recipient": f"""
        SELECT {pad('user_id')} AS provider_id, CAST(1995 + event_id % 7 AS INTEGER) AS report_year
        FROM events""",
    "last_orders": """
        SELECT c_custkey, c_acctbal, max(CAST(o_orderdate AS DATE)) AS day
        FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal""",
    "leie": f"""
        SELECT {pad('c_custkey')} AS provider_id,
               CASE c_custkey % 3 WHEN 0 THEN strftime(day, '%Y%m%d')
                    WHEN 1 THEN strftime(day, '%-m/%-d/%Y') ELSE strftime(day, '%Y-%m-%d') END AS EXCLDATE
        FROM last_orders WHERE c_acctbal < 0""",
    "exclusion_dates": """
        SELECT provider_id, CAST(min(coalesce(try_strptime(EXCLDATE, '%Y%m%d'),
                   try_strptime(EXCLDATE, '%m/%d/%Y'), try_strptime(EXCLDATE, '%Y-%m-%d'))) AS DATE)
                   AS exclusion_date
        FROM leie WHERE provider_id <> '0000000000' GROUP BY provider_id""",
    "cia": f"""
        SELECT DISTINCT {pad('c_custkey')} AS provider_id, day AS cia_flag_date
        FROM last_orders WHERE c_acctbal BETWEEN 0 AND 100 AND {pad('c_custkey')} <> '0000000000'""",
    "doj": f"""
        SELECT DISTINCT {pad('c_custkey')} AS provider_id
        FROM customer WHERE c_acctbal > 9880 AND {pad('c_custkey')} <> '0000000000'""",
    "payment_totals": """
        SELECT provider_id, report_year,
               CAST(sum(CAST(payment_amount AS DECIMAL(22,4))) AS DOUBLE) AS total_payments
        FROM payments GROUP BY provider_id, report_year""",
    "drug_totals": """
        SELECT provider_id, report_year, count(DISTINCT Brnd_Name) AS unique_drugs,
               CAST(sum(Tot_Clms) AS BIGINT) AS total_drug_claims
        FROM drug GROUP BY provider_id, report_year""",
    "recipient_totals": """
        SELECT provider_id, report_year, count(*) AS recipient_interactions
        FROM recipient GROUP BY provider_id, report_year""",
    "assembled": """
        SELECT p.*, coalesce(total_payments, 0.0) AS total_payments, coalesce(unique_drugs, 0) AS unique_drugs,
               coalesce(total_drug_claims, 0) AS total_drug_claims,
               coalesce(recipient_interactions, 0) AS recipient_interactions
        FROM prescribers p
        LEFT JOIN payment_totals USING (provider_id, report_year)
        LEFT JOIN drug_totals USING (provider_id, report_year)
        LEFT JOIN recipient_totals USING (provider_id, report_year)""",
    "filled": """
        SELECT * REPLACE (coalesce(Tot_Clms, 0) AS Tot_Clms, coalesce(Tot_Benes, 0) AS Tot_Benes,
                          coalesce(Tot_Drug_Cst, 0.0) AS Tot_Drug_Cst) FROM assembled""",
    "featured": """
        SELECT *, total_drug_claims / (unique_drugs + 1) AS claims_per_drug,
               CASE WHEN Tot_Clms <> 0 THEN Tot_Drug_Cst / Tot_Clms ELSE 0.0 END AS avg_cost_per_claim,
               CASE WHEN Tot_Clms <> 0 THEN total_payments / Tot_Clms ELSE 0.0 END AS payment_per_claim,
               CASE WHEN Tot_Benes <> 0 THEN Tot_Clms / Tot_Benes ELSE 0.0 END AS claims_per_beneficiary,
               ln(1 + total_payments) AS log_payments,
               CASE WHEN total_payments > 10000 THEN 1 ELSE 0 END AS high_payment_flag,
               CASE WHEN Tot_Clms <> 0 AND Tot_Drug_Cst / Tot_Clms > 500 THEN 1 ELSE 0 END AS high_cost_flag
        FROM filled""",
    "sanitized": """
        SELECT * REPLACE (coalesce(Opioid_Prscrbr_Rate, 0.0) AS Opioid_Prscrbr_Rate,
                          coalesce(Opioid_LA_Prscrbr_Rate, 0.0) AS Opioid_LA_Prscrbr_Rate) FROM featured""",
    "ranked": f"""
        SELECT *, percent_rank() OVER (PARTITION BY {PEERS} ORDER BY Opioid_Prscrbr_Rate)
                   AS opioid_peer_percentile,
               percent_rank() OVER (PARTITION BY {PEERS} ORDER BY payment_per_claim)
                   AS payment_peer_percentile
        FROM sanitized""",
    "outliers": """
        SELECT *, CASE WHEN Opioid_Prscrbr_Rate > 0 AND opioid_peer_percentile >= 0.99 THEN 1 ELSE 0 END
                   AS opioid_outlier_flag,
               CASE WHEN payment_per_claim > 0 AND payment_peer_percentile >= 0.99 THEN 1 ELSE 0 END
                   AS payment_outlier_flag
        FROM ranked""",
    "behavior": """
        SELECT *, CASE WHEN opioid_outlier_flag = 1 OR payment_outlier_flag = 1 OR high_payment_flag = 1
                   OR high_cost_flag = 1 THEN 1 ELSE 0 END AS behavioral_risk_flag
        FROM outliers""",
    "temporal": f"""
        SELECT b.*, exclusion_date,
               CASE WHEN exclusion_date <= make_date(report_year, 12, 31) THEN 1 ELSE 0 END
                   AS excluded_on_or_before_report_year,
               {horizon('exclusion_date')} AS is_future_fraud
        FROM behavior b LEFT JOIN exclusion_dates USING (provider_id)""",
    "listed": """
        SELECT t.*, CASE WHEN c.provider_id IS NULL THEN 0 ELSE 1 END AS cia_flag,
               CASE WHEN d.provider_id IS NULL THEN 0 ELSE 1 END AS doj_flag
        FROM temporal t LEFT JOIN cia c USING (provider_id) LEFT JOIN doj d USING (provider_id)""",
    "labeled": """
        SELECT *, is_future_fraud AS high_confidence_fraud_flag, is_future_fraud AS is_fraud,
               CASE WHEN cia_flag = 1 OR doj_flag = 1 THEN 1 ELSE 0 END AS enforcement_risk_flag,
               is_future_fraud + greatest(cia_flag, doj_flag) + behavioral_risk_flag
                   AS multi_signal_label_strength
        FROM listed""",
    "cohort": "SELECT * FROM labeled WHERE excluded_on_or_before_report_year = 0",
    "scored": f"""
        SELECT *, 1 / (1 + exp(-(log_payments - {STAND_IN_SHIFT}
                   + {STAND_IN_OPIOID} * Opioid_Prscrbr_Rate / 100))) AS supervised_score
        FROM cohort""",
    "anomaly_input": """
        SELECT * REPLACE (coalesce(Bene_Avg_Risk_Scre, 0.0) AS Bene_Avg_Risk_Scre,
                          CAST(total_drug_claims AS DOUBLE) AS total_drug_claims,
                          CAST(recipient_interactions AS DOUBLE) AS recipient_interactions),
               coalesce(Prscrbr_Type, 'UNKNOWN_TYPE') || '::' || coalesce(Prscrbr_State_Abrvtn, 'UNKNOWN_STATE')
                   AS peer_group
        FROM scored""",
    "peer_stats": f"""
        SELECT peer_group, count(*) AS peer_group_count, {moments('peer')}
        FROM anomaly_input GROUP BY peer_group""",
    "global_stats": f"SELECT {moments('global')} FROM anomaly_input",
    "peer_and_global": f"""
        SELECT *, {', '.join(f'{peer_score(n)} AS {n}_peer_score' for n in FEATURES)},
               {', '.join(f'{global_score(n)} AS {n}_global_score' for n in FEATURES)}
        FROM anomaly_input LEFT JOIN peer_stats USING (peer_group) CROSS JOIN global_stats""",
    "components": f"""
        SELECT *, {', '.join(f'{c} AS {n}_anomaly_component' for n, c in zip(FEATURES, COMPONENTS))}
        FROM peer_and_global""",
    "anomaly": f"""
        SELECT *, ({' + '.join(f'{n}_anomaly_component' for n in FEATURES)}) / {len(FEATURES)}.0
                   AS anomaly_score
        FROM components""",
    "hybrid": f"""
        SELECT * REPLACE ({clamp('supervised_score')} AS supervised_score,
                          {clamp('anomaly_score')} AS anomaly_score),
               {clamp('supervised_score')} * 0.6 + {clamp('anomaly_score')} * 0.4 AS hybrid_risk_score
        FROM anomaly""",
    "banded": """
        SELECT *, CASE WHEN hybrid_risk_score >= 0.9 THEN 'critical' WHEN hybrid_risk_score >= 0.75 THEN 'high'
                   WHEN hybrid_risk_score >= 0.55 THEN 'medium' ELSE 'low' END AS hybrid_risk_band
        FROM hybrid""",
}


def with_stages(body: str, doubles: list[str] | tuple[str, ...] = ()) -> str:
    """A full statement: every stage as a CTE, then `body` with its doubles on a 1e-6 grid."""
    stages = ", ".join(f"{name} AS ({text})" for name, text in STAGES.items())
    if doubles:
        grid = ", ".join(f"CASE WHEN abs({name} * 1e6) < 'inf'::DOUBLE THEN round_even({name} * 1e6, 0) / 1e6 ELSE {name} END AS {name}" for name in doubles)
        body = f"SELECT * REPLACE ({grid}) FROM ({body})"
    return f"WITH {stages} {body}"
