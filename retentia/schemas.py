"""Fixed column sets and schemas shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# The names below must equal the reference's table contract.
RAW_COLUMNS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate",
               "Price", "Customer ID", "Country"]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

ID_COLUMNS = ["CustomerID", "invoice_month", "T"]
FEATURE_COLUMNS = ["rev_sum_30d", "rev_sum_90d", "rev_sum_180d", "freq_30d", "freq_90d",
                   "rev_std_90d", "return_count_90d", "aov_90d", "gap_days_prev"]
TRAINING_ONLY_COLUMNS = ["has_future_purchase_90d", "churn_90d", "customer_value_90d"]
PREDICTION_OUTPUT_COLUMNS = [
    "CustomerID", "invoice_month", "T", "churn_prob", "value_pos", "policy_ml",
    "assumed_success_rate_customer", "intervention_cost_customer",
    "expected_retained_value", "expected_cost", "policy_net_benefit",
    "decision_simulation_assumption_driven",
]
TARGET_LIST_COLUMNS = [
    "CustomerID", "invoice_month", "T", "churn_prob", "value_pos", "policy_ml",
    "decision_targeting_policy", "assumed_success_rate_customer",
    "intervention_cost_customer", "expected_retained_value", "expected_cost",
    "policy_net_benefit",
]
# Columns never allowed as model inputs (label, future value, derived scores).
MODEL_DENY_COLUMNS = {
    "CustomerID", "invoice_month", "T", "has_future_purchase_90d", "churn_90d",
    "customer_value_90d", "value_proxy", "value_pos", "recency_risk", "rfm_risk",
    "policy_ml", "policy_recency", "policy_rfm", "churn_prob", "r_rank", "f_rank",
    "m_rank", "prev_event_ts", "label_observed",
}
POLICY_COLUMNS = ["policy_ml", "policy_net_benefit", "policy_recency", "policy_rfm"]
LABEL = "churn_90d"

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)
