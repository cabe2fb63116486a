"""Registered model, attribution and request-scoring queries."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from . import sql_checks as S
from .queries import query
from .queries_analytics import AB_SQL
from .queries_survival import SURV_COVARIATES
from .requests import explain, predict, predict_fitted, segment, uplift_request_frame, validate_requests
from .retention import features_table, fitted_batch_scores, stored_threshold
from ..functions.features import FEATURE_COLS, short_form_features
from ..functions.scoring import CONTROL_SCORER
from ..operators import attribution as AT
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import survival as SV
from ..operators import uplift as U
from ..session import stable
from ..sources import io as IO
from ..sources.bridge import ab_outcomes

HASH_SQL = "((CAST(substring(customerID, 2) AS BIGINT) * 2654435761 + 42) % 4294967296)"
UPLIFT_FEATURES = ("tenure", "monthly_charges", "contract_type", "service_count", "clv_proxy",
                   "senior_citizen", "has_partner", "digital_engagement")


_MODELS: dict = {}


def _features(spark, sf_dir):
    """The features, derived once per (session, tables): splits, folds, weights, fits and
    scores all read the rows written here."""
    key = (spark.sparkContext.applicationId, sf_dir, "features")
    if key not in _MODELS:
        _MODELS[key] = stable(features_table(spark, sf_dir))
    return _MODELS[key]


@query("stratified_split", S.with_(*S.FEATURE_CHAIN) + f"""
SELECT customerID, Churn_binary,
  CAST(row_number() OVER (PARTITION BY Churn_binary ORDER BY {HASH_SQL})
       <= ceil(count(*) OVER (PARTITION BY Churn_binary) * 0.2) AS INTEGER) AS is_test
FROM feat""")
def stratified_split(spark, sf_dir):
    """M1: exact per-label 80/20 split in hash order."""
    f = features_table(spark, sf_dir, with_high_value=False)
    return ML.stratified_split(f, "customerID", "Churn_binary").select("customerID", "Churn_binary",
                                                                       "is_test")


@query("plain_split", S.with_(*S.FEATURE_CHAIN) + f"""
SELECT customerID, CAST({HASH_SQL} < 858993459 AS INTEGER) AS is_test FROM feat""")
def plain_split(spark, sf_dir):
    """M2: hash-threshold split."""
    f = features_table(spark, sf_dir, with_high_value=False)
    return ML.plain_split(f, "customerID").select("customerID", "is_test")


def _train_eval(spark, sf_dir):
    """Train once per (session, tables) and share between the model queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key] = _fit(spark, sf_dir)
    return _MODELS[key]


def _fit(spark, sf_dir):
    f = ML.stratified_split(_features(spark, sf_dir), "customerID", "Churn_binary")
    f = ML.with_weight(f, "Churn_binary", F.col("is_test") == 0)
    f = f.withColumn("is_validation", F.col("is_test") == 1)
    f = stable(f)
    model = ML.train_boosted(f, FEATURE_COLS, "Churn_binary", validation="is_validation")
    test = stable(ML.score(model, f.where(F.col("is_test") == 1)))
    return model, test


@query("train_churn_gbt")
def train_churn_gbt(spark, sf_dir):
    """M3–M5 + E1/E3/E4: weighted boosted trees with early stopping on the
    hold-out, its AUC, the F1-tuned threshold and metrics at it (``>=``)."""
    model, test = _train_eval(spark, sf_dir)
    auc = M.roc_auc(test, "churn_probability", "Churn_binary")
    t = M.best_f1_threshold(test, "churn_probability", "Churn_binary").select("threshold").scalar()
    at = M.threshold_metrics(test, "churn_probability", "Churn_binary", t)
    n_trees = len(model.trees)
    return auc.select("auc", t.alias("threshold"), at.select("f1").scalar().alias("f1"),
                      at.select("precision").scalar().alias("precision"),
                      at.select("recall").scalar().alias("recall"), F.lit(n_trees).alias("n_trees"))


@query("champion_evaluation")
def champion_evaluation(spark, sf_dir):
    """The trained model on its hold-out – AUC, metrics at the tuned
    threshold with ``>`` (the evaluation script's comparison, SURVEY D8) and
    the classification report."""
    from ..operators.registry import evaluate_champion
    _, test = _train_eval(spark, sf_dir)
    t = M.best_f1_threshold(test, "churn_probability", "Churn_binary").first()["threshold"]
    auc, m, rep = evaluate_champion(test, "Churn_binary", t)
    return rep.withColumns({"auc": auc.select("auc").scalar(), "threshold": F.lit(float(t)),
                            "f1_at_threshold": m.select("f1").scalar()})


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """M7: gain and split importance of the churn model."""
    model, _ = _train_eval(spark, sf_dir)
    return ML.feature_importance(model)


def _tree_attr(spark, sf_dir):
    model, _ = _train_eval(spark, sf_dir)
    return AT.tree_attributions(_features(spark, sf_dir), model, FEATURE_COLS, "customerID")


@query("tree_attribution_importance")
def tree_attribution_importance(spark, sf_dir):
    """E13 (tree form) + E14: mean |attribution| per feature of the boosted
    churn model over every customer."""
    return AT.global_importance(_tree_attr(spark, sf_dir), "customerID")


@query("tree_top_drivers")
def tree_top_drivers(spark, sf_dir):
    """E15 over tree attributions: five drivers and protectors per customer
    (the explain payload for every row)."""
    return AT.top_drivers(_tree_attr(spark, sf_dir), "customerID", 5)


@query("cross_validated_auc")
def cross_validated_auc(spark, sf_dir):
    """M6: 5-fold stratified CV of the boosted churn model's AUC."""
    return ML.cross_validate(_features(spark, sf_dir), FEATURE_COLS, "Churn_binary")


def _uplift_models(spark, sf_dir):
    """The A/B table with its split and the T-learner of its training part, fitted once
    per (session, tables)."""
    key = (spark.sparkContext.applicationId, sf_dir, "uplift")
    if key not in _MODELS:
        ab = stable(ML.plain_split(ab_outcomes(spark, sf_dir), "user_id"))
        _MODELS[key] = ab, ML.t_learner(ab.where(F.col("is_test") == 0), UPLIFT_FEATURES, "treated", "churned")
    return _MODELS[key]


@query("uplift_t_learner")
def uplift_t_learner(spark, sf_dir):
    """M8/M9 + E12: T-learner on the A/B table, AUUC on the hold-out and the
    seeded random-order baseline."""
    ab, (m0, m1) = _uplift_models(spark, sf_dir)
    test = stable(ML.uplift_scores(m0, m1, ab.where(F.col("is_test") == 1)).withColumn(
        "retained", 1 - F.col("churned")))
    model_auuc = U.auuc(U.uplift_curve(test, "uplift_score", "treated", "retained", "user_id"))
    base = U.random_order_auuc(test, "treated", "retained", "user_id")
    return model_auuc.select("auuc", base.select("auuc").scalar().alias("auuc_random"), "n")


def _tuned_threshold(spark, sf_dir) -> float:
    """The churn model's F1-tuned threshold, stored as training does and read back."""
    _, test = _train_eval(spark, sf_dir)
    path = IO.join_path(IO.work_dir(spark, "model_config"), "config")
    IO.write_summary(M.best_f1_threshold(test, "churn_probability", "Churn_binary").select(F.col("threshold").alias("churn_threshold")), path)
    return stored_threshold(spark, path)


@query("fitted_batch_scores")
def fitted_scores(spark, sf_dir):
    """R8 with the fitted models: boosted churn model at its stored threshold,
    T-learner and Cox model over every customer."""
    feats = _features(spark, sf_dir)
    with ThreadPoolExecutor(1) as pool:  # the T-learner's short jobs fill the gaps between those of the churn model
        uplift = pool.submit(inheritable_thread_target(spark)(_uplift_models), spark, sf_dir)
        model, _ = _train_eval(spark, sf_dir)
        fit = SV.cox_fit(feats, "tenure", "Churn_binary", SURV_COVARIATES, penalizer=0.1)
        _, arms = uplift.result()
    return fitted_batch_scores(feats, model, _tuned_threshold(spark, sf_dir), *arms, fit)


@query("request_predict_fitted")
def request_predict_fitted(spark, sf_dir):
    """R9 /predict with the fitted churn and Cox models: probability, label at the
    stored threshold and the survival block of every customer's request."""
    model, _ = _train_eval(spark, sf_dir)
    feats = _features(spark, sf_dir)
    fit = SV.cox_fit(feats, "tenure", "Churn_binary", SURV_COVARIATES, penalizer=0.1)
    return predict_fitted(feats.withColumnRenamed("customerID", "request_id"), model, _tuned_threshold(spark, sf_dir), fit)


@query("request_explain")
def request_explain(spark, sf_dir):
    """R9 /explain: base value and the five drivers and protectors of every customer's
    request by the fitted churn model."""
    model, _ = _train_eval(spark, sf_dir)
    return explain(_features(spark, sf_dir).withColumnRenamed("customerID", "request_id"), model)


# ------------------------------------------------------------------ E13–E16
_ATTR_SQL = S.with_(*S.FEATURE_CHAIN, """
att AS (
  SELECT customerID,
    -0.04e0 * (CAST(tenure AS DOUBLE) - (SELECT avg(CAST(tenure AS DOUBLE)) FROM feat)) AS shap_tenure,
    -0.7e0 * (CAST(Contract_encoded AS DOUBLE) - (SELECT avg(CAST(Contract_encoded AS DOUBLE)) FROM feat))
      AS shap_Contract_encoded,
    0.02e0 * (MonthlyCharges - (SELECT avg(MonthlyCharges) FROM feat)) AS shap_MonthlyCharges,
    2.0e0 + -0.04e0 * ((SELECT avg(CAST(tenure AS DOUBLE)) FROM feat) - 0.0e0)
      + -0.7e0 * ((SELECT avg(CAST(Contract_encoded AS DOUBLE)) FROM feat) - 0.0e0)
      + 0.02e0 * ((SELECT avg(MonthlyCharges) FROM feat) - 60.0e0) AS base_value
  FROM feat),
attl AS (
  SELECT customerID, 'tenure' AS feature, shap_tenure AS contribution FROM att
  UNION ALL SELECT customerID, 'Contract_encoded', shap_Contract_encoded FROM att
  UNION ALL SELECT customerID, 'MonthlyCharges', shap_MonthlyCharges FROM att)""")


def _attr(spark, sf_dir):
    f = features_table(spark, sf_dir, with_high_value=False)
    return f, AT.linear_attributions(f, CONTROL_SCORER, "customerID")


@query("linear_attributions", _ATTR_SQL + "SELECT * FROM att",
       doubles=("shap_tenure", "shap_Contract_encoded", "shap_MonthlyCharges", "base_value"))
def linear_attributions(spark, sf_dir):
    """Exact additive attributions of the fixed churn scorer."""
    return _attr(spark, sf_dir)[1]


@query("global_attribution", _ATTR_SQL + """
SELECT feature, avg(abs(contribution)) AS mean_abs_shap FROM attl GROUP BY feature""",
       doubles=("mean_abs_shap",))
def global_attribution(spark, sf_dir):
    """Mean |contribution| per feature."""
    return AT.global_importance(_attr(spark, sf_dir)[1], "customerID")


@query("top_drivers", _ATTR_SQL + """
SELECT customerID, 'driver' AS kind,
       CAST(row_number() OVER (PARTITION BY customerID ORDER BY contribution DESC, feature DESC) AS INTEGER) AS rank,
       feature, contribution AS value FROM attl
UNION ALL
SELECT customerID, 'protector', CAST(row_number() OVER (PARTITION BY customerID ORDER BY contribution ASC, feature ASC) AS INTEGER),
       feature, contribution FROM attl""", doubles=("value",))
def top_drivers(spark, sf_dir):
    """E15 (W7): per customer, contributions ranked as drivers and protectors."""
    return AT.top_drivers(_attr(spark, sf_dir)[1], "customerID", 5)


@query("attribution_dependence", _ATTR_SQL + """
SELECT a.customerID, a.feature, a.contribution,
  CASE a.feature WHEN 'tenure' THEN CAST(f.tenure AS DOUBLE) WHEN 'Contract_encoded' THEN CAST(f.Contract_encoded AS DOUBLE)
       ELSE f.MonthlyCharges END AS feature_value
FROM attl a JOIN feat f USING (customerID)""", doubles=("contribution", "feature_value"))
def attribution_dependence(spark, sf_dir):
    """(value, contribution) pairs for the dependence view."""
    f, attr = _attr(spark, sf_dir)
    return AT.dependence(f, attr, "customerID", ["tenure", "Contract_encoded", "MonthlyCharges"])


# ------------------------------------------------------------------ R9, P25, S13

_PRED_SQL = """
pr AS (
  SELECT customerID AS request_id,
    1.0e0 / (1.0e0 + exp(-(2.0e0 + (-0.04e0) * tenure + (-0.7e0) * Contract_encoded
                           + 0.02e0 * (MonthlyCharges - 60.0e0)))) AS p0,
    1.0e0 / (1.0e0 + exp(-(2.8e0 + (-0.04e0) * tenure + (-0.7e0) * Contract_encoded
                           + 0.02e0 * (MonthlyCharges - 60.0e0) + (-1.6e0) * digital_engagement))) AS p1
  FROM feat)"""


@query("request_predict", S.with_(*S.FEATURE_CHAIN, _PRED_SQL) + """
SELECT request_id, round_even(p0 * 10000.0e0, 0) / 10000.0e0 AS churn_probability,
       CAST(p0 >= 0.5 AS INTEGER) AS churn_predicted, 0.5e0 AS threshold_used FROM pr""",
       doubles=("churn_probability", "threshold_used"))
def request_predict(spark, sf_dir):
    """R9 /predict over a request table built from every customer's features."""
    f = features_table(spark, sf_dir, with_high_value=False).withColumnRenamed("customerID", "request_id")
    return predict(f, 0.5)


@query("request_segment", S.with_(*S.FEATURE_CHAIN, _PRED_SQL) + f"""
SELECT request_id, round_even((p0 - p1) * 10000.0e0, 0) / 10000.0e0 AS uplift_score,
  round_even(p0 * 10000.0e0, 0) / 10000.0e0 AS p_churn_no_action,
  round_even(p1 * 10000.0e0, 0) / 10000.0e0 AS p_churn_with_voucher,
  {S.SEGMENT_CASE.format(u='(p0 - p1)', p='p0')} AS segment,
  CASE {S.SEGMENT_CASE.format(u='(p0 - p1)', p='p0')} WHEN 'Persuadable' THEN 'Send voucher 20%'
    WHEN 'Sleeping_Dog' THEN 'Do NOT contact' WHEN 'Lost_Cause' THEN 'Escalate to CS team'
    ELSE 'No action needed' END AS recommended_action,
  CASE {S.SEGMENT_CASE.format(u='(p0 - p1)', p='p0')} WHEN 'Persuadable' THEN 'HIGH'
    WHEN 'Sleeping_Dog' THEN 'SUPPRESS' WHEN 'Lost_Cause' THEN 'LOW' ELSE 'NONE' END AS priority
FROM pr""", doubles=("uplift_score", "p_churn_no_action", "p_churn_with_voucher"))
def request_segment(spark, sf_dir):
    """R9 /segment over the 8-field uplift requests of every customer."""
    f = features_table(spark, sf_dir, with_high_value=False)
    return segment(uplift_request_frame(f))


_SF_COLS = ", ".join(FEATURE_COLS)


@query("short_form_requests", S.with_(*S.FEATURE_CHAIN, """
sf AS (SELECT customerID AS request_id, CAST(tenure AS DOUBLE) AS t, MonthlyCharges AS m,
              Contract_encoded AS cc, InternetService_encoded AS ic, SeniorCitizen AS senior,
              Partner AS partner, service_count AS sc, digital_engagement AS de FROM feat),
sf2 AS (SELECT *, m * greatest(t, 1.0e0) AS total FROM sf),
sf3 AS (SELECT *, total * (1.0e0 - 1.0e0 / (t + 1)) AS clv FROM sf2),
out AS (SELECT request_id, t AS tenure, CAST(senior AS DOUBLE) AS SeniorCitizen, m AS MonthlyCharges,
  total AS TotalCharges, CAST(partner AS DOUBLE) AS Partner, 0.0e0 AS Dependents, 1.0e0 AS PhoneService,
  1.0e0 AS PaperlessBilling, 0.0e0 AS MultipleLines, 0.0e0 AS OnlineSecurity, 0.0e0 AS OnlineBackup,
  0.0e0 AS DeviceProtection, 0.0e0 AS TechSupport, 1.0e0 AS StreamingTV, 1.0e0 AS StreamingMovies,
  CAST(cc AS DOUBLE) AS Contract_encoded, CAST(ic AS DOUBLE) AS InternetService_encoded,
  0.0e0 AS PaymentMethod_encoded, 1.0e0 / (t + 1) AS recency_risk, CAST(sc AS DOUBLE) AS service_count,
  total AS monetary_value, m / (total + 1) AS monthly_to_total_ratio, m / (t + 1) AS charge_per_month,
  clv AS clv_proxy, CAST(clv > 500.0e0 AS DOUBLE) AS is_high_value, CAST(cc AS DOUBLE) * t AS contract_stability,
  CAST(de AS DOUBLE) AS digital_engagement FROM sf3)""") + f"SELECT request_id, {_SF_COLS} FROM out",
       doubles=FEATURE_COLS)
def short_form_requests(spark, sf_dir):
    """P25: lookup-form requests expanded to the 27-field contract."""
    f = features_table(spark, sf_dir, with_high_value=False)
    req = f.select(F.col("customerID").alias("request_id"), "tenure", "MonthlyCharges", "Contract_encoded",
                   "InternetService_encoded", "SeniorCitizen", "Partner", "service_count",
                   "digital_engagement").withColumnsRenamed({
                       "MonthlyCharges": "monthly_charges", "Contract_encoded": "contract_code",
                       "InternetService_encoded": "internet_code", "SeniorCitizen": "senior",
                       "Partner": "partner"})
    return short_form_features(req)


@query("request_validation", S.with_(S.CUSTOMERS_RAW, S.ENCODED_TRAINING) + """
SELECT CAST(count_if(PaymentMethod_encoded IS NOT NULL AND InternetService_encoded IS NOT NULL) AS BIGINT) AS valid,
       CAST(count_if(PaymentMethod_encoded IS NULL OR InternetService_encoded IS NULL) AS BIGINT) AS rejected
FROM enc""")
def request_validation(spark, sf_dir):
    """Requests with any of the 27 required fields missing are rejected
    (training encodings leave unmapped labels NULL, so those rows are rejected)."""
    valid, rejected = validate_requests(features_table(spark, sf_dir, "training"))
    return valid.select(F.count(F.lit(1)).alias("valid")).select(
        "valid", rejected.select(F.count(F.lit(1))).scalar().alias("rejected"))
