"""End-to-end compositions: ETL features, batch scores, targeting (§3 A).

Each function returns a lazy DataFrame; Catalyst sees the whole chain from
the parquet scans to the result, prunes unused columns and pushes filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encode import encode_customers
from ..functions.features import derive_features, round_half_even
from ..functions.rules import segment_absolute, threshold_flag
from ..functions.scoring import retention_scores
from ..operators.decision import budget_plan
from ..operators.models import score
from ..operators.survival import expected_remaining
from ..sources.bridge import customers_raw
from ..sources.io import read_summary

DEFAULT_THRESHOLD = 0.5


def features_table(spark: SparkSession, sf_dir: str, profile: str = "etl",
                   with_high_value: bool = True) -> DataFrame:
    """customers → lenient parse → encode → derived features."""
    raw = customers_raw(spark, sf_dir)
    return derive_features(encode_customers(raw, profile), profile, with_high_value)


def batch_scores(features: DataFrame, threshold=DEFAULT_THRESHOLD,
                 remaining: Column | None = None, scored_at: Column | None = None,
                 scored: DataFrame | None = None) -> DataFrame:
    """Churn probability and label, uplift, segment, expected remaining
    tenure (−1 without a survival model), clv; half-even rounding as the
    score file has it.  ``scored`` may carry model outputs
    (churn_probability, uplift_score) already; otherwise the fixed
    retention scorer supplies them."""
    s = scored if scored is not None else retention_scores(features)
    seg = segment_absolute(F.col("uplift_score"), F.col("churn_probability"))
    rem = remaining if remaining is not None else F.lit(-1.0)
    out = s.select(
        F.col("customerID").alias("user_id"),
        round_half_even("churn_probability", 4).alias("churn_probability"),
        threshold_flag(F.col("churn_probability"), threshold).alias("churn_predicted"),
        round_half_even("uplift_score", 4).alias("uplift_score"),
        seg.alias("segment"),
        rem.cast("double").alias("expected_tenure_remaining"),
        round_half_even("clv_proxy", 2).alias("clv_proxy"),
        *([] if scored_at is None else [scored_at.alias("scored_at")]),
    )
    return out


def stored_threshold(spark: SparkSession, path: str, default: float = DEFAULT_THRESHOLD) -> float:
    """The decision threshold that the last training stored in the summary at ``path``,
    ``default`` where there is none."""
    found = read_summary(spark, path, "churn_threshold double")
    row = found.first() if found is not None else None
    return default if row is None or row["churn_threshold"] is None else float(row["churn_threshold"])


def fitted_batch_scores(features: DataFrame, model, threshold: float, m0, m1, fit: dict | None = None,
                        scored_at: Column | None = None) -> DataFrame:
    """R8 by fitted models: churn by ``model``, uplift by the T-learner's arms
    ``m0`` (control) and ``m1`` (treated), remaining tenure by the Cox model ``fit``
    (−1 without one)."""
    from .requests import fitted_uplift
    scored = score(model, fitted_uplift(features, m0, m1))
    remaining = None
    if fit is not None:
        scored = expected_remaining(scored, fit)
        remaining = F.col("expected_tenure_remaining")
    return batch_scores(features, threshold, remaining, scored_at, scored)


def targeting(spark: SparkSession, sf_dir: str, budget: float = 5000.0,
              risk_quantile: float | None = 0.70):
    """Flagship: raw customers → features → scores → segments → actions →
    value/roi → budgeted target list.  Returns (plan, within_budget)."""
    scores = batch_scores(features_table(spark, sf_dir, with_high_value=False))
    return budget_plan(scores, budget=budget, risk_quantile=risk_quantile)
