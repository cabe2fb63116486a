"""Independent SQL formulations used as correctness oracles.

These are plain ANSI/DuckDB SQL over the supplied tables.  They restate the
semantics of the operators (not their distributed strategy): un-partitioned
windows, ``quantile_cont``, brute-force pair joins on the small check scale.
Double literals are written with an exponent so the SQL engine does not
switch to fixed-point decimal arithmetic.
"""

from __future__ import annotations

ONLINE = (("online_security", 19), ("online_backup", 23), ("device_protection", 29),
          ("tech_support", 31), ("streaming_tv", 37), ("streaming_movies", 41))

_online_sql = ",\n".join(
    f"    CASE WHEN (id // 11) % 3 = 2 THEN 'No internet service' "
    f"WHEN (id // {k}) % 2 = 1 THEN 'Yes' ELSE 'No' END AS {name}"
    for name, k in ONLINE)

CUSTOMERS_RAW = f"""
spans AS (
  SELECT o_custkey AS id, min(CAST(o_orderdate AS DATE)) AS first_order,
         max(CAST(o_orderdate AS DATE)) AS last_order
  FROM orders GROUP BY o_custkey
),
cbase AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS id,
         CAST(coalesce(least(72, date_diff('day', s.first_order, s.last_order) // 30), 0) AS INTEGER) AS tenure,
         CAST(1800 + floor((c.c_acctbal + 1000) * 100 / 110) AS BIGINT) AS mc,
         s.last_order
  FROM customer c LEFT JOIN spans s ON s.id = c.c_custkey
),
customers_raw AS (
  SELECT 'C' || CAST(id AS VARCHAR) AS customer_id,
    CASE WHEN id % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN (id // 7) % 6 = 0 THEN 1 ELSE 0 END AS senior_citizen,
    CASE WHEN (id // 2) % 2 = 1 THEN 'Yes' ELSE 'No' END AS partner,
    CASE WHEN (id // 13) % 3 = 0 THEN 'Yes' ELSE 'No' END AS dependents,
    tenure,
    'Yes' AS phone_service,
    CASE (id // 17) % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'No phone service' END AS multiple_lines,
    CASE (id // 11) % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS internet_service,
{_online_sql},
    CASE id % 3 WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'One year' ELSE 'Two year' END AS contract,
    CASE WHEN (id // 5) % 2 = 1 THEN 'Yes' ELSE 'No' END AS paperless_billing,
    CASE (id // 3) % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer' ELSE 'Credit card' END AS payment_method,
    CAST(mc AS DOUBLE) / 100.0e0 AS monthly_charges,
    CASE WHEN id % 10 = 0 THEN ' ' ELSE CAST((mc * tenure) // 100 AS VARCHAR) || '.' ||
         lpad(CAST((mc * tenure) % 100 AS VARCHAR), 2, '0') END AS total_charges,
    CASE WHEN last_order IS NULL OR date_diff('day', last_order, DATE '2001-08-01') > 180
         THEN 'Yes' ELSE 'No' END AS churn
  FROM cbase
)"""

_bin = "CASE {c} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'Female' THEN 1 WHEN 'Male' THEN 0 ELSE 0 END"
_tbin = ("CASE {c} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'No phone service' THEN 0 "
         "WHEN 'No internet service' THEN 0 ELSE NULL END")

ENCODED_ETL = f"""
enc AS (
  SELECT customer_id AS customerID,
    {_bin.format(c='gender')} AS gender,
    {_bin.format(c='partner')} AS Partner,
    {_bin.format(c='dependents')} AS Dependents,
    {_bin.format(c='phone_service')} AS PhoneService,
    {_bin.format(c='paperless_billing')} AS PaperlessBilling,
    CASE WHEN multiple_lines = 'Yes' THEN 1 ELSE 0 END AS MultipleLines,
    CASE WHEN online_security = 'Yes' THEN 1 ELSE 0 END AS OnlineSecurity,
    CASE WHEN online_backup = 'Yes' THEN 1 ELSE 0 END AS OnlineBackup,
    CASE WHEN device_protection = 'Yes' THEN 1 ELSE 0 END AS DeviceProtection,
    CASE WHEN tech_support = 'Yes' THEN 1 ELSE 0 END AS TechSupport,
    CASE WHEN streaming_tv = 'Yes' THEN 1 ELSE 0 END AS StreamingTV,
    CASE WHEN streaming_movies = 'Yes' THEN 1 ELSE 0 END AS StreamingMovies,
    CASE internet_service WHEN 'DSL' THEN 0 WHEN 'Fiber optic' THEN 1 WHEN 'No' THEN 2 ELSE 2 END AS InternetService_encoded,
    CASE contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 ELSE 0 END AS Contract_encoded,
    CASE payment_method WHEN 'Electronic check' THEN 0 WHEN 'Mailed check' THEN 1
         WHEN 'Bank transfer' THEN 2 WHEN 'Credit card' THEN 3 ELSE 0 END AS PaymentMethod_encoded,
    {_bin.format(c='churn')} AS Churn_binary,
    senior_citizen AS SeniorCitizen, tenure, monthly_charges AS MonthlyCharges,
    coalesce(TRY_CAST(trim(total_charges) AS DOUBLE), 0.0e0) AS TotalCharges,
    internet_service, contract, payment_method
  FROM customers_raw
)"""

ENCODED_TRAINING = f"""
enc AS (
  SELECT customer_id AS customerID,
    CASE gender WHEN 'Male' THEN 1 WHEN 'Female' THEN 0 ELSE NULL END AS gender,
    {_tbin.format(c='partner')} AS Partner,
    {_tbin.format(c='dependents')} AS Dependents,
    {_tbin.format(c='phone_service')} AS PhoneService,
    {_tbin.format(c='paperless_billing')} AS PaperlessBilling,
    {_tbin.format(c='multiple_lines')} AS MultipleLines,
    {_tbin.format(c='online_security')} AS OnlineSecurity,
    {_tbin.format(c='online_backup')} AS OnlineBackup,
    {_tbin.format(c='device_protection')} AS DeviceProtection,
    {_tbin.format(c='tech_support')} AS TechSupport,
    {_tbin.format(c='streaming_tv')} AS StreamingTV,
    {_tbin.format(c='streaming_movies')} AS StreamingMovies,
    CASE internet_service WHEN 'No' THEN 0 WHEN 'DSL' THEN 1 WHEN 'Fiber optic' THEN 2 ELSE NULL END AS InternetService_encoded,
    CASE contract WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 2 ELSE NULL END AS Contract_encoded,
    CASE payment_method WHEN 'Electronic check' THEN 0 WHEN 'Mailed check' THEN 1
         WHEN 'Bank transfer (automatic)' THEN 2 WHEN 'Credit card (automatic)' THEN 3 ELSE NULL END AS PaymentMethod_encoded,
    CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS Churn_binary,
    senior_citizen AS SeniorCitizen, tenure, monthly_charges AS MonthlyCharges,
    coalesce(TRY_CAST(trim(total_charges) AS DOUBLE), 0.0e0) AS TotalCharges,
    internet_service, contract, payment_method
  FROM customers_raw
)"""


def _feat(service_cols, paperless_expr):
    svc = " + ".join(f"coalesce({c}, 0)" for c in service_cols)
    return f"""
feat0 AS (
  SELECT *, 1.0e0 / (tenure + 1) AS recency_risk,
    CAST({svc} AS INTEGER) AS service_count,
    TotalCharges AS monetary_value,
    MonthlyCharges / (TotalCharges + 1) AS monthly_to_total_ratio,
    MonthlyCharges / (tenure + 1) AS charge_per_month
  FROM enc
),
feat AS (
  SELECT *, TotalCharges * (1.0e0 - recency_risk) AS clv_proxy,
    CAST(Contract_encoded * tenure AS INTEGER) AS contract_stability,
    CAST({paperless_expr} + (CASE WHEN PaymentMethod_encoded >= 2 THEN 1 ELSE 0 END) AS INTEGER)
      AS digital_engagement
  FROM feat0
)"""


_SVC_ETL = ("MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
            "TechSupport", "StreamingTV", "StreamingMovies")
FEATURES_ETL = _feat(_SVC_ETL, "(CASE WHEN PaperlessBilling = 1 THEN 1 ELSE 0 END)")
FEATURES_TRAINING = _feat(("PhoneService",) + _SVC_ETL, "PaperlessBilling")

HIGH_VALUE = """
featv AS (
  SELECT *, CAST(clv_proxy > (SELECT quantile_cont(clv_proxy, 0.75) FROM feat) AS INTEGER) AS is_high_value
  FROM feat
)"""

SCORES = """
sc AS (
  SELECT *,
    1.0e0 / (1.0e0 + exp(-(2.0e0 + (-0.04e0) * tenure + (-0.7e0) * Contract_encoded
                           + 0.02e0 * (MonthlyCharges - 60.0e0)))) AS p_control,
    1.0e0 / (1.0e0 + exp(-(2.8e0 + (-0.04e0) * tenure + (-0.7e0) * Contract_encoded
                           + 0.02e0 * (MonthlyCharges - 60.0e0) + (-1.6e0) * digital_engagement))) AS p_treated
  FROM feat
),
scu AS (
  SELECT *, p_control - p_treated AS uplift_score, p_control AS churn_probability,
    round_even(p_control * 10000.0e0, 0) / 10000.0e0 AS score4,
    round_even((p_control - p_treated) * 10000.0e0, 0) / 10000.0e0 AS uplift4 FROM sc
)"""

SEGMENT_CASE = """CASE WHEN {u} >= 0.25 AND {p} >= 0.5 THEN 'Persuadable'
         WHEN {u} <= -0.1 THEN 'Sleeping_Dog'
         WHEN {p} >= 0.6 THEN 'Lost_Cause' ELSE 'Sure_Thing' END"""

BATCH_SCORES = f"""
bs AS (
  SELECT customerID AS user_id,
    round_even((churn_probability) * 10000.0e0, 0) / 10000.0e0 AS churn_probability,
    CASE WHEN churn_probability >= 0.5 THEN 1 ELSE 0 END AS churn_predicted,
    round_even((uplift_score) * 10000.0e0, 0) / 10000.0e0 AS uplift_score,
    {SEGMENT_CASE.format(u='uplift_score', p='churn_probability')} AS segment,
    -1.0e0 AS expected_tenure_remaining,
    round_even((clv_proxy) * 100.0e0, 0) / 100.0e0 AS clv_proxy
  FROM scu
)"""

ACTIONS = """
act AS (
  SELECT *, (SELECT quantile_cont(clv_proxy, 0.75) FROM bs) AS clv_threshold FROM bs
),
act2 AS (
  SELECT *, CASE WHEN clv_proxy > clv_threshold THEN 1 ELSE 0 END AS is_vip,
    CASE WHEN segment = 'Persuadable' AND clv_proxy > clv_threshold THEN 'Voucher 20% + CS Call'
         WHEN segment = 'Persuadable' THEN 'Email Voucher 10%'
         WHEN segment = 'Sleeping_Dog' THEN 'SUPPRESS'
         WHEN segment = 'Lost_Cause' THEN 'Escalate CS' ELSE 'No Action' END AS recommended_action,
    CASE WHEN segment = 'Persuadable' AND clv_proxy > clv_threshold THEN 50
         WHEN segment = 'Persuadable' THEN 10
         WHEN segment = 'Lost_Cause' THEN 30 ELSE 0 END AS action_cost
  FROM act
),
val AS (
  SELECT *, round_even((churn_probability * clv_proxy * greatest(uplift_score, 0.0e0)) * 100.0e0, 0) / 100.0e0 AS expected_clv_saved
  FROM act2
),
roi AS (
  SELECT *, round_even((CASE WHEN action_cost > 0 THEN expected_clv_saved / action_cost ELSE 0.0e0 END) * 100.0e0, 0) / 100.0e0 AS roi
  FROM val
)"""


def with_(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip("\n") for b in blocks) + "\n"


FEATURE_CHAIN = (CUSTOMERS_RAW, ENCODED_ETL, FEATURES_ETL)
SCORE_CHAIN = FEATURE_CHAIN + (SCORES, BATCH_SCORES)
