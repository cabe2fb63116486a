"""Row rules as native column expressions (R1, R2 rule, F3, C1–C3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Absolute segment thresholds (both bounds inclusive, checked in
# this order) and segment names.
PERSUADABLE_MIN_UPLIFT = 0.25
PERSUADABLE_MIN_CHURN = 0.50
SLEEPING_DOG_MAX_UPLIFT = -0.10
LOST_CAUSE_MIN_CHURN = 0.60
PERSUADABLE, SLEEPING_DOG, LOST_CAUSE, SURE_THING = (
    "Persuadable", "Sleeping_Dog", "Lost_Cause", "Sure_Thing")
SEGMENTS = (PERSUADABLE, SLEEPING_DOG, LOST_CAUSE, SURE_THING)

# Percentile segmenter defaults.
PCT_HIGH = 0.70
PCT_LOW = 0.30
PCT_CHURN = 0.50

# Dashboard bands.
RISK_RED, RISK_AMBER = 0.7, 0.4
DRIFT_BANDS = (0.3, 0.6)


def segment_absolute(uplift: Column, churn: Column,
                     min_uplift: float = PERSUADABLE_MIN_UPLIFT,
                     min_churn: float = PERSUADABLE_MIN_CHURN,
                     sleeping_max: float = SLEEPING_DOG_MAX_UPLIFT,
                     lost_min_churn: float = LOST_CAUSE_MIN_CHURN) -> Column:
    """R1.  The churn column is an explicit argument."""
    return (F.when((uplift >= min_uplift) & (churn >= min_churn), F.lit(PERSUADABLE))
            .when(uplift <= sleeping_max, F.lit(SLEEPING_DOG))
            .when(churn >= lost_min_churn, F.lit(LOST_CAUSE))
            .otherwise(F.lit(SURE_THING)))


def segment_by_percentile(pct: Column, uplift: Column, churn: Column,
                          high: float = PCT_HIGH, low: float = PCT_LOW,
                          churn_min: float = PCT_CHURN) -> Column:
    """R2 rule over a precomputed uplift percentile (see operators.ranking)."""
    return (F.when((pct >= high) & (churn >= churn_min), F.lit(PERSUADABLE))
            .when((pct < low) & (uplift < 0), F.lit(SLEEPING_DOG))
            .when((churn >= churn_min) & (pct < high), F.lit(LOST_CAUSE))
            .otherwise(F.lit(SURE_THING)))


def threshold_flag(score: Column, threshold, inclusive: bool = True) -> Column:
    """1 when the score passes the threshold (``>=`` by default, SURVEY D8)."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (score >= t if inclusive else score > t).cast("int")


def risk_light(p: Column) -> Column:
    """Red / amber / green."""
    return (F.when(p > RISK_RED, F.lit("red")).when(p > RISK_AMBER, F.lit("amber"))
            .otherwise(F.lit("green")))


def drift_band(score: Column) -> Column:
    """Gauge band of a drift share."""
    lo, hi = DRIFT_BANDS
    return (F.when(score < lo, F.lit("low")).when(score < hi, F.lit("medium"))
            .otherwise(F.lit("high")))


def run_kind(metrics: Column, run_name: Column) -> Column:
    """Classify a run from its metric map and name:
    AUC-ROC / C-index / AUUC / first metric."""
    name = F.lower(F.coalesce(run_name, F.lit("")))
    has = lambda k: F.map_contains_key(metrics, F.lit(k))
    return (F.when(has("auc_roc") | has("auc") | name.contains("lightgbm") | name.contains("lgbm"),
                   F.lit("AUC-ROC"))
            .when(has("c_index") | name.contains("cox") | name.contains("survival"), F.lit("C-index"))
            .when(has("auuc") | name.contains("uplift"), F.lit("AUUC"))
            .when(F.size(metrics) > 0, F.array_sort(F.map_keys(metrics))[0])
            .otherwise(F.lit(None).cast("string")))
