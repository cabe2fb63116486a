"""Registered queries: one per operator (or operator family) of SURVEY §2,
each paired with an SQL oracle where the semantics are SQL-expressible.

Every query reads the supplied tables (or data Spark derives from them) in
full; no row caps, id subsets or sampling are applied for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import sql_checks as S
from .retention import batch_scores, features_table, targeting
from ..operators import decision as D

QUERIES: dict = {}
ORACLES: dict = {}


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns so results compare independent of summation order."""
    scale = float(10 ** digits)
    return df.select(*[(F.rint(F.col(f.name) * scale) / scale).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def rounded_sql(sql: str, double_cols, digits: int = 6) -> str:
    if not double_cols:
        return sql
    scale = f"{10 ** digits}.0e0"
    rep = ", ".join(f"round_even({c} * {scale}, 0) / {scale} AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


def query(name: str, sql: str | None = None, doubles=()):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: finish(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = rounded_sql(sql, doubles)
        return fn
    return deco


# ---------------------------------------------------------------- flagship


TARGET_COLS = ["user_id", "segment", "recommended_action", "action_cost",
               "expected_clv_saved", "roi", "churn_probability", "cumulative_cost"]


@query("retention_targeting", S.with_(*S.SCORE_CHAIN, S.ACTIONS, """
ranked AS (
  SELECT *, CAST(SUM(action_cost) OVER (ORDER BY roi DESC, user_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_cost
  FROM roi
  WHERE segment = 'Persuadable'
    AND churn_probability >= (SELECT quantile_cont(churn_probability, 0.70) FROM bs)
)""") + """
SELECT user_id, segment, recommended_action, action_cost, expected_clv_saved, roi,
       churn_probability, cumulative_cost
FROM ranked WHERE cumulative_cost <= 5000""",
       doubles=("expected_clv_saved", "roi", "churn_probability"))
def retention_targeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 end to end."""
    _, within = targeting(spark, sf_dir)
    return within.select(*TARGET_COLS)


_FEATURE_OUT = ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
                "PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup",
                "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
                "PaperlessBilling", "MonthlyCharges", "TotalCharges", "Churn_binary",
                "InternetService_encoded", "Contract_encoded", "PaymentMethod_encoded",
                "internet_service", "contract", "payment_method",
                "recency_risk", "service_count", "monetary_value", "monthly_to_total_ratio",
                "charge_per_month", "clv_proxy", "contract_stability", "digital_engagement",
                "is_high_value"]
_FEATURE_DOUBLES = ("MonthlyCharges", "TotalCharges", "recency_risk", "monetary_value",
                    "monthly_to_total_ratio", "charge_per_month", "clv_proxy")


@query("customer_features_etl",
       S.with_(*S.FEATURE_CHAIN, S.HIGH_VALUE) + f"SELECT {', '.join(_FEATURE_OUT)} FROM featv",
       doubles=_FEATURE_DOUBLES)
def customer_features_etl(spark, sf_dir):
    """ETL feature table (P1, P2, P4, P6–P8 etl profile, P9–P19)."""
    return features_table(spark, sf_dir, "etl").select(*_FEATURE_OUT)


@query("customer_features_training",
       S.with_(S.CUSTOMERS_RAW, S.ENCODED_TRAINING, S.FEATURES_TRAINING, S.HIGH_VALUE)
       + f"SELECT {', '.join(_FEATURE_OUT)} FROM featv",
       doubles=_FEATURE_DOUBLES)
def customer_features_training(spark, sf_dir):
    """Training-profile feature table (P3, P5, P7 training map, NULL for unmapped)."""
    return features_table(spark, sf_dir, "training").select(*_FEATURE_OUT)


_BS_COLS = ["user_id", "churn_probability", "churn_predicted", "uplift_score", "segment",
            "expected_tenure_remaining", "clv_proxy"]


@query("batch_scores", S.with_(*S.SCORE_CHAIN) + f"SELECT {', '.join(_BS_COLS)} FROM bs",
       doubles=("churn_probability", "uplift_score", "expected_tenure_remaining", "clv_proxy"))
def batch_scores_q(spark, sf_dir):
    """R8 with the fixed scorer (M4/M9 shape, R1, F3, P23)."""
    return batch_scores(features_table(spark, sf_dir, with_high_value=False)).select(*_BS_COLS)


_PLAN_COLS = ["user_id", "segment", "churn_probability", "uplift_score", "clv_proxy",
              "clv_threshold", "is_vip", "recommended_action", "action_cost",
              "expected_clv_saved", "roi", "cumulative_cost", "targeted"]
_PLAN_SQL = S.with_(*S.SCORE_CHAIN, S.ACTIONS, """
marked AS (
  SELECT *, CASE WHEN segment = 'Persuadable'
    AND churn_probability >= (SELECT quantile_cont(churn_probability, 0.70) FROM bs)
    THEN 1 ELSE 0 END AS actionable FROM roi
),
ranked AS (
  SELECT *, CASE WHEN actionable = 1 THEN CAST(SUM(action_cost) OVER (PARTITION BY actionable
     ORDER BY roi DESC, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END
     AS cumulative_cost
  FROM marked
)""")


@query("action_plan", _PLAN_SQL + f"""
SELECT {', '.join(_PLAN_COLS[:-1])},
       CASE WHEN cumulative_cost <= 5000 THEN 1 ELSE 0 END AS targeted FROM ranked""",
       doubles=("churn_probability", "uplift_score", "clv_proxy", "clv_threshold",
                "expected_clv_saved", "roi"))
def action_plan(spark, sf_dir):
    """Every customer with action, cost, value, roi, targeted flag."""
    plan, _ = targeting(spark, sf_dir)
    return plan.select(*_PLAN_COLS)


@query("campaign_report", _PLAN_SQL + """
SELECT CAST(count_if(cumulative_cost <= 5000) AS BIGINT) AS targeted_users,
       CAST(coalesce(sum(CASE WHEN cumulative_cost <= 5000 THEN action_cost END), 0) AS BIGINT) AS total_cost,
       sum(CASE WHEN cumulative_cost <= 5000 THEN expected_clv_saved END) AS expected_clv_saved,
       avg(CASE WHEN cumulative_cost <= 5000 THEN roi END) AS avg_roi,
       CAST(count_if(segment = 'Sleeping_Dog') AS BIGINT) AS sleeping_dogs_suppressed
FROM ranked""", doubles=("expected_clv_saved", "avg_roi"))
def campaign_report_q(spark, sf_dir):
    """A13 summary."""
    plan, _ = targeting(spark, sf_dir)
    return D.campaign_report(plan)


@query("action_breakdown", _PLAN_SQL + """
SELECT recommended_action, count(*) AS users FROM ranked
WHERE cumulative_cost <= 5000 GROUP BY recommended_action""")
def action_breakdown_q(spark, sf_dir):
    """A13 per-action counts of the targeted list."""
    _, within = targeting(spark, sf_dir)
    return D.action_breakdown(within)


@query("budget_what_if", S.with_(*S.SCORE_CHAIN, S.ACTIONS, """
ranked AS (
  SELECT *, SUM(action_cost) OVER (ORDER BY roi DESC, user_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_cost
  FROM roi WHERE segment = 'Persuadable'
),
budgets AS (SELECT CAST(b AS INTEGER) AS budget FROM range(1000, 20001, 500) t(b))""") + """
SELECT b.budget,
       CAST(count(r.user_id) AS BIGINT) AS targeted_users,
       CAST(coalesce(sum(r.action_cost), 0) AS BIGINT) AS total_cost,
       coalesce(sum(r.expected_clv_saved), 0.0e0) AS expected_clv_saved,
       CASE WHEN count(r.user_id) > 0 THEN sum(r.roi) / count(r.user_id) END AS avg_roi
FROM budgets b LEFT JOIN ranked r ON r.cumulative_cost <= b.budget
GROUP BY b.budget""", doubles=("expected_clv_saved", "avg_roi"))
def budget_what_if_q(spark, sf_dir):
    """All 39 budgets of the planner grid in one pass."""
    scores = batch_scores(features_table(spark, sf_dir, with_high_value=False))
    return D.budget_what_if(scores)


# further registrations live in sibling modules
from . import queries_analytics  # noqa: E402,F401
from . import queries_survival  # noqa: E402,F401
from . import queries_drift  # noqa: E402,F401
from . import queries_models  # noqa: E402,F401
from . import queries_io  # noqa: E402,F401
from . import queries_extra  # noqa: E402,F401
