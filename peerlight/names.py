"""Column names and fixed settings shared by the operators."""

PROVIDER_ID = "provider_id"
REPORT_YEAR = "report_year"
GRAIN = (PROVIDER_ID, REPORT_YEAR)

LABEL = "is_fraud"
PEER_TYPE = "Prscrbr_Type"
PEER_STATE = "Prscrbr_State_Abrvtn"
PEER_KEYS = (PEER_TYPE, PEER_STATE)
PEER_GROUP = "peer_group"
PEER_COUNT = "peer_group_count"

SUPERVISED_SCORE = "supervised_score"
ANOMALY_SCORE = "anomaly_score"
HYBRID_SCORE = "hybrid_risk_score"
HYBRID_BAND = "hybrid_risk_band"
CLASS_WEIGHT = "class_weight"

# The defaults every published result depends on.
DEFAULT_REPORT_YEAR = 2023
DEFAULT_HORIZON_YEARS = 2
KEY_LENGTH = 10
PLACEHOLDER_KEY = "0" * KEY_LENGTH
HIGH_PAYMENT = 10000
HIGH_COST_PER_CLAIM = 500
OUTLIER_PERCENTILE = 0.99
MIN_PEER_GROUP_SIZE = 25
Z_SCORE_SPAN = 4.0
ANOMALY_FLAG_CUT = 0.65
SUPERVISED_SHARE = 0.6
ANOMALY_SHARE = 0.4
RISK_BANDS = (("critical", 0.9), ("high", 0.75), ("medium", 0.55))
LOWEST_BAND = "low"

# Columns that feed the anomaly score.
ANOMALY_FEATURES = (
    "total_payments",
    "payment_per_claim",
    "avg_cost_per_claim",
    "claims_per_beneficiary",
    "Opioid_Prscrbr_Rate",
    "Opioid_LA_Prscrbr_Rate",
    "total_drug_claims",
    "recipient_interactions",
    "Bene_Avg_Risk_Scre",
)

# Columns of the compact risk table, in output order.
COMPACT_COLUMNS = (
    "provider_id",
    "hybrid_risk_score",
    "hybrid_risk_band",
    "supervised_score",
    "anomaly_score",
    "is_fraud",
    "high_confidence_fraud_flag",
    "behavioral_risk_flag",
    "opioid_outlier_flag",
    "payment_outlier_flag",
    "Prscrbr_Type",
    "Prscrbr_State_Abrvtn",
    "total_payments",
    "payment_per_claim",
    "avg_cost_per_claim",
    "claims_per_beneficiary",
    "Opioid_Prscrbr_Rate",
    "recipient_interactions",
    "unique_drugs",
)

# Flags counted by the signal coverage report.
SIGNAL_FLAGS = (
    "high_confidence_fraud_flag",
    "cia_flag",
    "doj_flag",
    "opioid_outlier_flag",
    "payment_outlier_flag",
    "behavioral_risk_flag",
    "enforcement_risk_flag",
)

# Numeric columns that would leak the label into a model.
LEAKY_COLUMNS = frozenset(
    [
        "is_fraud",
        "provider_id",
        "is_future_fraud",
        "exclusion_date",
        "excluded_on_or_before_report_year",
        "high_confidence_fraud_flag",
        "cia_flag",
        "doj_flag",
        "enforcement_risk_flag",
        "behavioral_risk_flag",
        "multi_signal_label_strength",
        "opioid_outlier_flag",
        "payment_outlier_flag",
        "opioid_peer_percentile",
        "payment_peer_percentile",
        "anomaly_flag",
        "anomaly_score",
        "supervised_score",
        "hybrid_risk_score",
    ]
)


def grain_of(df, keys=GRAIN):
    """The grain columns `df` really has: the provider, and the year if it is there."""
    return [name for name in keys if name in df.columns]
