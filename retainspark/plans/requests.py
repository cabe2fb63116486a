"""Request-table scoring (R9): the predict / segment payloads for many rows.

The reference answered one customer per HTTP call; here a table of requests
is scored with the same plan as the batch path, so a customer gets the same
answer either way (SURVEY D5 is resolved by passing the churn column the
segment rule uses explicitly).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import FEATURE_COLS, UPLIFT_RENAME, round_half_even
from ..functions.rules import segment_absolute, threshold_flag
from ..functions.scoring import CONTROL_SCORER, TREATED_SCORER, LinearScorer
from ..operators import attribution as AT
from ..operators import survival as SV
from ..operators.decision import segment_actions
from ..operators.models import score, uplift_scores
from ..operators.ranking import top_k_per_row

REQUIRED = FEATURE_COLS


def validate_requests(req: DataFrame, required=REQUIRED):
    """Rows missing any required field go to the rejects table with the
    list of missing fields; returns (valid, rejected)."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]),
                       lambda x: x.isNotNull())
    tagged = req.withColumn("missing_fields", missing)
    return (tagged.where(F.size("missing_fields") == 0).drop("missing_fields"),
            tagged.where(F.size("missing_fields") > 0))


def predict(req: DataFrame, threshold=0.5, scorer: LinearScorer = CONTROL_SCORER,
            id_col: str = "request_id") -> DataFrame:
    """/predict for every request row: probability (4 decimals), label at the
    tuned threshold (``>=``) and the threshold used."""
    p = scorer.probability()
    t = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    return req.select(id_col, round_half_even(p, 4).alias("churn_probability"),
                      threshold_flag(p, t).alias("churn_predicted"),
                      round_half_even(t, 4).alias("threshold_used"))


#: The survival block's horizons.
HORIZONS = (7, 30, 90)


def predict_fitted(req: DataFrame, model, threshold, fit: dict, id_col: str = "request_id") -> DataFrame:
    """/predict by the fitted churn model and the fitted Cox model ``fit``: as
    ``predict``, with the share still active after 7, 30 and 90 (4 decimals).  A
    request with a missing survival covariate has no survival block (NULLs)."""
    scored = SV.survival_at(score(model, req), fit, HORIZONS)
    p, t = F.col("churn_probability"), F.lit(float(threshold))
    return scored.select(id_col, round_half_even(p, 4).alias("churn_probability"), threshold_flag(p, t).alias("churn_predicted"),
                         round_half_even(t, 4).alias("threshold_used"),
                         *[round_half_even(f"p_active_{h}", 4).alias(f"p_active_{h}d") for h in HORIZONS])


def explain(req: DataFrame, model, features=FEATURE_COLS, id_col: str = "request_id", k: int = 5) -> DataFrame:
    """/explain for every request: the model's base value (log-odds) and the ``k``
    greatest and ``k`` smallest contributions as JSON objects in that order, 4 decimals."""
    attr = AT.tree_attributions(req, model, features, id_col)
    named = attr.select(id_col, "base_value", *[F.col(f"shap_{f}").alias(f) for f in features])
    top = top_k_per_row(named, features, k)
    payload = lambda c: F.to_json(F.map_from_entries(F.transform(
        c, lambda x: F.struct(x["feature"], F.rint(x["value"] * 10000) / 10000))))
    return top.select(id_col, "base_value", payload("top").alias("top_churn_drivers"), payload("bottom").alias("top_churn_protectors"))


def fitted_uplift(features: DataFrame, m0, m1) -> DataFrame:
    """``features`` with the fitted T-learner's ``p_churn_control``,
    ``p_churn_treated`` and ``uplift_score``, read by the uplift request's names."""
    added = {v: F.col(k) for k, v in UPLIFT_RENAME.items() if k != v}
    return uplift_scores(m0, m1, features.withColumns(added)).drop(*added)


def segment(req: DataFrame, control: LinearScorer = CONTROL_SCORER,
            treated: LinearScorer = TREATED_SCORER, id_col: str = "request_id") -> DataFrame:
    """/segment: uplift = P(no action) − P(voucher); the segment rule uses
    P(no action) as the churn probability, then action and priority."""
    p0, p1 = control.probability(), treated.probability()
    s = req.select(id_col, p0.alias("__p0"), p1.alias("__p1"))
    s = s.withColumn("segment", segment_absolute(F.col("__p0") - F.col("__p1"), F.col("__p0")))
    s = segment_actions(s)
    return s.select(id_col, round_half_even(F.col("__p0") - F.col("__p1"), 4).alias("uplift_score"),
                    round_half_even("__p0", 4).alias("p_churn_no_action"),
                    round_half_even("__p1", 4).alias("p_churn_with_voucher"),
                    "segment", "recommended_action", "priority")


def uplift_request_frame(features: DataFrame, id_col: str = "customerID") -> DataFrame:
    """The 8-field uplift request built from feature rows (P19 renames) with
    the feature names the scorers read."""
    inv = {v: k for k, v in UPLIFT_RENAME.items()}
    up = features.select(F.col(id_col).alias("request_id"),
                         *[F.col(k).alias(v) for k, v in UPLIFT_RENAME.items()])
    return up.select("request_id", *[F.col(v).alias(inv[v]) for v in UPLIFT_RENAME.values()])
