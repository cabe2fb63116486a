"""Registered queries for profiling, evaluation, ranking and uplift operators."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from . import sql_checks as S
from .queries import query
from .retention import batch_scores, features_table, targeting
from ..functions.encode import encode_customers
from ..functions.rules import risk_light, segment_absolute
from ..functions.scoring import retention_scores
from ..operators import decision as D
from ..operators import metrics as M
from ..operators import profile as P
from ..operators import ranking as R
from ..operators import uplift as U
from ..operators.quantiles import exact_quantiles
from ..sources.bridge import ab_outcomes, customers_raw
from ..sources.tables import read_table

# ------------------------------------------------------------------ helpers


def _union_sql(parts):
    return "\nUNION ALL\n".join(parts)


def _eval_frame(spark, sf_dir):
    """features + fixed-scorer probabilities + label; ``score4`` is the
    probability at the score file's 4 decimals (ties then agree across engines)."""
    from ..functions.features import round_half_even
    s = retention_scores(features_table(spark, sf_dir, with_high_value=False))
    return s.withColumn("score4", round_half_even("churn_probability", 4))


EVAL_SQL = S.with_(*S.FEATURE_CHAIN, S.SCORES)
BS_SQL = S.with_(*S.SCORE_CHAIN)

AB_SQL_BLOCK = f"""
ab AS (
  SELECT customerID AS user_id, tenure, MonthlyCharges AS monthly_charges,
    Contract_encoded AS contract_type, service_count, clv_proxy, SeniorCitizen AS senior_citizen,
    Partner AS has_partner, digital_engagement,
    {S.SEGMENT_CASE.format(u='uplift_score', p='churn_probability')} AS segment_true,
    CAST(((CAST(substring(customerID, 2) AS BIGINT) * 7919) // 10) % 2 AS INTEGER) AS treated,
    p_control AS base_churn_prob,
    CASE WHEN ((CAST(substring(customerID, 2) AS BIGINT) * 7919) // 10) % 2 = 1
         THEN p_treated ELSE p_control END AS final_churn_prob,
    Churn_binary AS churned,
    CAST(CAST(substring(customerID, 2) AS BIGINT) % 8 + 1 AS INTEGER) AS week,
    uplift4 AS uplift_score
  FROM scu
)"""
AB_SQL = S.with_(*S.FEATURE_CHAIN, S.SCORES, AB_SQL_BLOCK)


def _ab_scored(spark, sf_dir):
    return ab_outcomes(spark, sf_dir)


# --------------------------------------------------------------- A1 describe

LINEITEM_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("describe_lineitem", _union_sql([
    f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
    f"quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM lineitem" for c in LINEITEM_NUM]),
    doubles=("mean", "std", "min", "q25", "q50", "q75", "max"))
def describe_lineitem(spark, sf_dir):
    """A1 over the whole lineitem table (exact quartiles at scale)."""
    return P.describe(read_table(spark, sf_dir, "lineitem"), LINEITEM_NUM)


# numeric feature columns (P21: selected by type from the feature table's schema)
_NUMERIC_FEATURES = ("gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
                     "MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
                     "StreamingTV", "StreamingMovies", "PaperlessBilling", "MonthlyCharges", "TotalCharges",
                     "Churn_binary", "InternetService_encoded", "Contract_encoded", "PaymentMethod_encoded",
                     "recency_risk", "service_count", "monetary_value", "monthly_to_total_ratio",
                     "charge_per_month", "clv_proxy", "contract_stability", "digital_engagement",
                     "is_high_value")


@query("describe_features", S.with_(*S.FEATURE_CHAIN, S.HIGH_VALUE) + _union_sql([
    f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM featv" for c in _NUMERIC_FEATURES]),
    doubles=("mean", "std", "min", "q25", "q50", "q75", "max"))
def describe_features(spark, sf_dir):
    """A1 over every numeric column of the feature table (P21 type selection)."""
    from ..functions.features import numeric_columns
    f = features_table(spark, sf_dir)
    return P.describe(f, numeric_columns(f))


# ----------------------------------------------------------- A2 missing
_TRAIN_ENC_COLS = ("gender", "Partner", "Dependents", "PhoneService", "PaperlessBilling",
                   "MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
                   "TechSupport", "StreamingTV", "StreamingMovies", "InternetService_encoded",
                   "Contract_encoded", "PaymentMethod_encoded", "Churn_binary", "SeniorCitizen",
                   "tenure", "MonthlyCharges", "TotalCharges")


@query("missing_profile_training", S.with_(S.CUSTOMERS_RAW, S.ENCODED_TRAINING) + "SELECT * FROM (\n"
       + _union_sql([f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS missing, "
                     f"(count(*) - count({c})) * 100.0e0 / count(*) AS missing_pct FROM enc"
                     for c in _TRAIN_ENC_COLS]) + "\n) WHERE missing > 0",
       doubles=("missing_pct",))
def missing_profile_training(spark, sf_dir):
    """A2 over the training-profile encoding (unmapped labels become NULL)."""
    enc = encode_customers(customers_raw(spark, sf_dir), "training")
    return P.missing_profile(enc, _TRAIN_ENC_COLS)


# --------------------------------------------------------------- A3 duplicates


@query("duplicate_documents", """
SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS k FROM documents GROUP BY text, lang, source) g""")
def duplicate_documents(spark, sf_dir):
    """A3 on whole document texts (content columns)."""
    return P.duplicate_count(read_table(spark, sf_dir, "documents"), ["text", "lang", "source"])


# ------------------------------------------------------------ A4 value counts


@query("value_counts_events", """
SELECT event_type, count(*) AS n, count(*) * 1.0e0 / (SELECT count(*) FROM events) AS share
FROM events GROUP BY event_type""", doubles=("share",))
def value_counts_events(spark, sf_dir):
    """A4 over the event stream table."""
    return P.value_counts(read_table(spark, sf_dir, "events"), "event_type")


# ------------------------------------------------------------ A5 rate by category
RATE_COLS = ("contract", "internet_service", "payment_method", "tech_support",
             "online_security", "paperless_billing")


@query("churn_rate_by_category", S.with_(S.CUSTOMERS_RAW) + _union_sql([
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, "
    f"avg(CASE WHEN churn = 'Yes' THEN 1.0e0 ELSE 0.0e0 END) * 100.0e0 AS rate, count(*) AS n "
    f"FROM customers_raw GROUP BY {c}" for c in RATE_COLS]), doubles=("rate",))
def churn_rate_by_category(spark, sf_dir):
    """A5: six categorical columns in one GROUPING SETS pass."""
    raw = customers_raw(spark, sf_dir).withColumn(
        "churn_flag", (F.col("churn") == "Yes").cast("int"))
    return P.rate_by_category(raw, "churn_flag", RATE_COLS)


# ------------------------------------------------------------ A6 group means


@query("group_means_by_churn", S.with_(*S.FEATURE_CHAIN) + """
SELECT Churn_binary, avg(tenure) AS avg_tenure, avg(MonthlyCharges) AS avg_MonthlyCharges,
       avg(TotalCharges) AS avg_TotalCharges FROM feat GROUP BY Churn_binary""",
       doubles=("avg_tenure", "avg_MonthlyCharges", "avg_TotalCharges"))
def group_means_by_churn(spark, sf_dir):
    """A6."""
    return P.group_means(features_table(spark, sf_dir, with_high_value=False), "Churn_binary",
                         ["tenure", "MonthlyCharges", "TotalCharges"])


# ------------------------------------------------------------ A7 / A8 correlations
CORR_COLS = ("tenure", "MonthlyCharges", "TotalCharges", "recency_risk", "service_count",
             "charge_per_month", "clv_proxy", "contract_stability", "digital_engagement",
             "SeniorCitizen", "Contract_encoded", "Churn_binary")
TARGET_CORR_COLS = ("recency_risk", "service_count", "monetary_value", "monthly_to_total_ratio",
                    "charge_per_month", "clv_proxy", "is_high_value", "contract_stability",
                    "digital_engagement", "tenure", "MonthlyCharges", "SeniorCitizen",
                    "Contract_encoded")


@query("correlation_matrix", S.with_(*S.FEATURE_CHAIN) + _union_sql([
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM feat"
    for a, b in combinations(CORR_COLS, 2)]), doubles=("corr",))
def correlation_matrix(spark, sf_dir):
    """All pairs in a single aggregate."""
    return P.correlation_matrix(features_table(spark, sf_dir, with_high_value=False), CORR_COLS)


@query("target_correlation", S.with_(*S.FEATURE_CHAIN, S.HIGH_VALUE) + "SELECT feature, corr, "
       "row_number() OVER (ORDER BY corr DESC NULLS LAST, feature) AS rank FROM (\n" + _union_sql([
           f"SELECT '{c}' AS feature, corr({c}, Churn_binary) AS corr FROM featv"
           for c in TARGET_CORR_COLS]) + "\n) t", doubles=("corr",))
def target_correlation(spark, sf_dir):
    """Correlation with churn, ranked."""
    return P.target_correlation(features_table(spark, sf_dir), "Churn_binary", TARGET_CORR_COLS)


# ------------------------------------------------------------ A9 treatment effect


@query("treatment_effect", AB_SQL + """
SELECT segment_true,
       avg(CASE WHEN treated = 0 THEN CAST(churned AS DOUBLE) END) AS control_rate,
       avg(CASE WHEN treated = 1 THEN CAST(churned AS DOUBLE) END) AS treated_rate,
       avg(CASE WHEN treated = 0 THEN CAST(churned AS DOUBLE) END)
         - avg(CASE WHEN treated = 1 THEN CAST(churned AS DOUBLE) END) AS uplift
FROM ab GROUP BY segment_true""", doubles=("control_rate", "treated_rate", "uplift"))
def treatment_effect(spark, sf_dir):
    """Pivot of churn by segment × arm on the A/B outcome table."""
    return P.pivot_effect(ab_outcomes(spark, sf_dir), "segment_true", "treated", "churned")


# ------------------------------------------------------------ A10 / A11 / A18 on scores


@query("portfolio_kpis", BS_SQL + """
SELECT count(*) AS total, CAST(count_if(churn_probability > 0.7) AS BIGINT) AS high_risk,
       count_if(churn_probability > 0.7) * 100.0e0 / count(*) AS high_risk_pct,
       CAST(count_if(segment = 'Persuadable') AS BIGINT) AS persuadable,
       count_if(segment = 'Persuadable') * 100.0e0 / count(*) AS persuadable_pct,
       avg(churn_probability) AS avg_churn_probability FROM bs""",
       doubles=("high_risk_pct", "persuadable_pct", "avg_churn_probability"))
def portfolio_kpis(spark, sf_dir):
    """A10."""
    return P.portfolio_kpis(batch_scores(features_table(spark, sf_dir, with_high_value=False)))


@query("score_histogram", BS_SQL + """,
b AS (SELECT min(churn_probability) AS lo, max(churn_probability) AS hi FROM bs),
h AS (
  SELECT CAST(least(49, floor((churn_probability - b.lo) * (50.0e0 / (b.hi - b.lo)))) AS INTEGER) AS bin,
         b.lo, b.hi FROM bs, b
)
SELECT bin, lo + bin * ((hi - lo) / 50.0e0) AS lower, lo + (bin + 1) * ((hi - lo) / 50.0e0) AS upper,
       count(*) AS n FROM h GROUP BY bin, lo, hi""", doubles=("lower", "upper"))
def score_histogram(spark, sf_dir):
    """50 equal-width bins of the churn probability."""
    return P.histogram(batch_scores(features_table(spark, sf_dir, with_high_value=False)),
                       "churn_probability", 50)


@query("roi_histogram", S.with_(*S.SCORE_CHAIN, S.ACTIONS, """
r AS (SELECT roi, SUM(action_cost) OVER (ORDER BY roi DESC, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cost
      FROM roi WHERE segment = 'Persuadable' AND churn_probability >= (SELECT quantile_cont(churn_probability, 0.70) FROM bs)),
w AS (SELECT roi FROM r WHERE cost <= 5000),
b AS (SELECT min(roi) AS lo, max(roi) AS hi FROM w),
h AS (SELECT CASE WHEN lo = hi THEN 0 ELSE CAST(least(29, floor((roi - lo) * (30.0e0 / nullif(hi - lo, 0)))) AS INTEGER) END AS bin,
             lo, hi FROM w, b)""") + """
SELECT bin, lo + bin * ((hi - lo) / 30.0e0) AS lower, lo + (bin + 1) * ((hi - lo) / 30.0e0) AS upper,
       count(*) AS n FROM h GROUP BY bin, lo, hi""", doubles=("lower", "upper"))
def roi_histogram(spark, sf_dir):
    """30 equal-width bins of the return of the users targeted within the budget."""
    return P.histogram(targeting(spark, sf_dir)[1], "roi", 30)


@query("score_density_by_class", S.with_(*S.FEATURE_CHAIN, S.SCORES, """
b AS (SELECT Churn_binary, min(score4) AS lo, max(score4) AS hi, count(*) AS t FROM scu GROUP BY 1),
h AS (SELECT Churn_binary, CAST(least(49, floor((score4 - lo) * (50.0e0 / (hi - lo)))) AS INTEGER) AS bin, lo, hi, t
      FROM scu JOIN b USING (Churn_binary))""") + """
SELECT Churn_binary, bin, lo + bin * ((hi - lo) / 50.0e0) AS lower, lo + (bin + 1) * ((hi - lo) / 50.0e0) AS upper,
       count(*) AS n, count(*) / (t * ((hi - lo) / 50.0e0)) AS density
FROM h GROUP BY Churn_binary, bin, lo, hi, t""", doubles=("lower", "upper", "density"))
def score_density_by_class(spark, sf_dir):
    """Density of the churn score in 50 bins, each label over its own range."""
    ev = _eval_frame(spark, sf_dir)
    one = lambda y: P.histogram(ev.where(F.col("Churn_binary") == y), "score4", 50, density=True).withColumn("Churn_binary", F.lit(y))
    return one(0).unionByName(one(1))


@query("score_audit", BS_SQL + """
SELECT count(*) AS rows, CAST(count_if(segment = 'Persuadable') AS BIGINT) AS n_persuadable,
       CAST(count_if(segment = 'Sleeping_Dog') AS BIGINT) AS n_sleeping_dog,
       CAST(count_if(segment = 'Lost_Cause') AS BIGINT) AS n_lost_cause,
       CAST(count_if(segment = 'Sure_Thing') AS BIGINT) AS n_sure_thing, avg(churn_probability) AS avg_churn_probability,
       sum(clv_proxy) AS total_clv FROM bs""", doubles=("avg_churn_probability", "total_clv"))
def score_audit(spark, sf_dir):
    """A18."""
    return P.score_audit(batch_scores(features_table(spark, sf_dir, with_high_value=False)))


# ------------------------------------------------------------ A12 quantiles
Q_COLS = ("churn_probability", "uplift_score", "clv_proxy")
Q_LEVELS = (0.25, 0.5, 0.7, 0.75)


@query("score_quantiles", BS_SQL + _union_sql([
    f"SELECT '{c}' AS column_name, {q}e0 AS q, quantile_cont({c}, {q}) AS value FROM bs"
    for c in Q_COLS for q in Q_LEVELS]), doubles=("q", "value"))
def score_quantiles(spark, sf_dir):
    """Exact linear-interpolated quantiles via distributed rank search."""
    return exact_quantiles(batch_scores(features_table(spark, sf_dir, with_high_value=False)),
                           Q_COLS, Q_LEVELS)


# ------------------------------------------------------------ A14 / A15


@query("table_audit", """
SELECT 'orders' AS table_name, count(*) AS rows, max(o_orderdate) AS latest FROM orders
UNION ALL SELECT 'lineitem', count(*), max(l_shipdate) FROM lineitem
UNION ALL SELECT 'events', count(*), max(ts) FROM events""")
def table_audit(spark, sf_dir):
    """Row count and latest timestamp per table, unioned."""
    t = lambda n: read_table(spark, sf_dir, n)
    return P.table_audit({"orders": (t("orders"), "o_orderdate"),
                          "lineitem": (t("lineitem"), "l_shipdate"),
                          "events": (t("events"), "ts")})


@query("class_ratio", S.with_(*S.FEATURE_CHAIN) + """
SELECT CAST(count_if(Churn_binary = 0) AS BIGINT) AS negatives,
       CAST(count_if(Churn_binary = 1) AS BIGINT) AS positives,
       count_if(Churn_binary = 0) * 1.0e0 / count_if(Churn_binary = 1) AS ratio FROM feat""",
       doubles=("ratio",))
def class_ratio(spark, sf_dir):
    """A15 (the positive-class weight of M5)."""
    return P.class_ratio(features_table(spark, sf_dir, with_high_value=False), "Churn_binary")


# ------------------------------------------------------------ A16 / A17


@query("confusion_matrix", EVAL_SQL + """
SELECT CAST(Churn_binary AS VARCHAR) AS actual,
       CAST(CASE WHEN score4 >= 0.5 THEN 1 ELSE 0 END AS VARCHAR) AS predicted,
       count(*) AS n FROM scu GROUP BY 1, 2""")
def confusion_matrix(spark, sf_dir):
    """A16 at the default threshold."""
    df = _eval_frame(spark, sf_dir).withColumn(
        "pred", (F.col("score4") >= 0.5).cast("int"))
    return M.confusion_matrix(df, "Churn_binary", "pred")


def _report_sql(src: str, actual: str, predicted: str) -> str:
    return f"""
cm AS (SELECT CAST({actual} AS VARCHAR) AS a, CAST({predicted} AS VARCHAR) AS p, count(*) AS n
       FROM {src} GROUP BY 1, 2),
labels AS (SELECT a AS label FROM cm UNION SELECT p FROM cm),
per AS (
  SELECT l.label,
    coalesce((SELECT sum(n) FROM cm WHERE a = l.label), 0) AS support,
    coalesce((SELECT sum(n) FROM cm WHERE p = l.label), 0) AS predicted_n,
    coalesce((SELECT sum(n) FROM cm WHERE a = l.label AND p = l.label), 0) AS tp
  FROM labels l
),
per2 AS (
  SELECT label, support, tp,
    CASE WHEN predicted_n > 0 THEN tp * 1.0e0 / predicted_n ELSE 0.0e0 END AS precision,
    CASE WHEN support > 0 THEN tp * 1.0e0 / support ELSE 0.0e0 END AS recall
  FROM per
),
per3 AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                 ELSE 0.0e0 END AS f1 FROM per2
)
SELECT label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM per3
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) * 1.0e0 / sum(support), CAST(sum(support) AS BIGINT) FROM per3
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per3
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per3"""


@query("classification_report_binary", EVAL_SQL + ",\nev AS (SELECT Churn_binary, CASE WHEN "
       "score4 >= 0.5 THEN 1 ELSE 0 END AS pred FROM scu)," + _report_sql(
           "ev", "Churn_binary", "pred"), doubles=("precision", "recall", "f1"))
def classification_report_binary(spark, sf_dir):
    """A17, binary."""
    df = _eval_frame(spark, sf_dir).withColumn(
        "pred", (F.col("score4") >= 0.5).cast("int"))
    return M.classification_report(df, "Churn_binary", "pred")


_PCT_SQL = """
pc AS (
  SELECT uplift_score, count(*) AS k FROM ab GROUP BY uplift_score
),
pr AS (
  SELECT uplift_score,
    (SUM(k) OVER (ORDER BY uplift_score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - k + 1
     + SUM(k) OVER (ORDER BY uplift_score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 2.0e0
     / (SELECT count(*) FROM ab) AS uplift_percentile
  FROM pc
),
seg AS (
  SELECT ab.*, pr.uplift_percentile,
    CASE WHEN pr.uplift_percentile >= 0.7 AND ab.base_churn_prob >= 0.5 THEN 'Persuadable'
         WHEN pr.uplift_percentile < 0.3 AND ab.uplift_score < 0 THEN 'Sleeping_Dog'
         WHEN ab.base_churn_prob >= 0.5 AND pr.uplift_percentile < 0.7 THEN 'Lost_Cause'
         ELSE 'Sure_Thing' END AS predicted_segment
  FROM ab JOIN pr ON ab.uplift_score = pr.uplift_score
)"""


def _percentile_segments(spark, sf_dir):
    return D.segment_by_uplift_percentile(_ab_scored(spark, sf_dir), "uplift_score", "base_churn_prob")


@query("segment_percentile", AB_SQL + "," + _PCT_SQL + """
SELECT user_id, uplift_score, base_churn_prob, uplift_percentile, predicted_segment FROM seg""",
       doubles=("uplift_score", "base_churn_prob", "uplift_percentile"))
def segment_percentile(spark, sf_dir):
    """R2 with W3 (average-rank percentile of the uplift)."""
    return _percentile_segments(spark, sf_dir).select(
        "user_id", "uplift_score", "base_churn_prob", "uplift_percentile", "predicted_segment")


@query("classification_report_segments", AB_SQL + "," + _PCT_SQL + "," + _report_sql(
    "seg", "segment_true", "predicted_segment"), doubles=("precision", "recall", "f1"))
def classification_report_segments(spark, sf_dir):
    """A17, 4-class: percentile segments against the absolute-rule segments."""
    return M.classification_report(_percentile_segments(spark, sf_dir), "segment_true",
                                   "predicted_segment")


# ------------------------------------------------------------ E1–E4
_CURVE_SQL = EVAL_SQL + """,
sc2 AS (SELECT score4 AS score, count_if(Churn_binary = 1) AS pos,
               count_if(Churn_binary <> 1) AS neg FROM scu GROUP BY 1),
pts AS (
  SELECT score AS threshold,
    SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    SUM(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
  FROM sc2
),
pts2 AS (
  SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
    tp * 1.0e0 / (SELECT sum(pos) FROM sc2) AS tpr, fp * 1.0e0 / (SELECT sum(neg) FROM sc2) AS fpr,
    CASE WHEN tp + fp > 0 THEN tp * 1.0e0 / (tp + fp) ELSE 0.0e0 END AS precision,
    tp * 1.0e0 / (SELECT sum(pos) FROM sc2) AS recall
  FROM pts
),
pts3 AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM pts2)"""


@query("roc_auc", EVAL_SQL + """,
sc2 AS (SELECT score4 AS score, count_if(Churn_binary = 1) AS pos,
               count_if(Churn_binary <> 1) AS neg FROM scu GROUP BY 1),
r AS (SELECT *, coalesce(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS neg_below FROM sc2)
SELECT sum(pos * (neg_below + neg / 2.0e0)) / (sum(pos) * sum(neg)) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM r""",
       doubles=("auc",))
def roc_auc(spark, sf_dir):
    """E1 with tie-averaged ranks."""
    return M.roc_auc(_eval_frame(spark, sf_dir), "score4", "Churn_binary")


@query("curve_points", _CURVE_SQL + "\nSELECT * FROM pts3",
       doubles=("threshold", "tpr", "fpr", "precision", "recall", "f1"))
def curve_points(spark, sf_dir):
    """ROC / PR points per distinct score."""
    return M.curve_points(_eval_frame(spark, sf_dir), "score4", "Churn_binary")


@query("best_f1_threshold", _CURVE_SQL + """
SELECT threshold, f1, precision, recall FROM pts3 ORDER BY f1 DESC, threshold ASC LIMIT 1""",
       doubles=("threshold", "f1", "precision", "recall"))
def best_f1_threshold(spark, sf_dir):
    """F1-maximising threshold (ties → lowest threshold)."""
    return M.best_f1_threshold(_eval_frame(spark, sf_dir), "score4", "Churn_binary")


@query("metrics_at_tuned_threshold", _CURVE_SQL + """,
t AS (SELECT threshold FROM pts3 ORDER BY f1 DESC, threshold ASC LIMIT 1),
k AS (SELECT count_if(score4 >= t.threshold AND Churn_binary = 1) AS tp,
             count_if(score4 >= t.threshold AND Churn_binary <> 1) AS fp,
             count_if(score4 < t.threshold AND Churn_binary = 1) AS fn,
             count_if(score4 < t.threshold AND Churn_binary <> 1) AS tn FROM scu, t),
k2 AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp * 1.0e0 / (tp + fp) ELSE 0.0e0 END AS precision,
              CASE WHEN tp + fn > 0 THEN tp * 1.0e0 / (tp + fn) ELSE 0.0e0 END AS recall FROM k)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
       CAST(tn AS BIGINT) AS tn, precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0e0 END AS f1,
       (tp + tn) * 1.0e0 / (tp + fp + fn + tn) AS accuracy FROM k2""",
       doubles=("precision", "recall", "f1", "accuracy"))
def metrics_at_tuned_threshold(spark, sf_dir):
    """E4 at the E3 threshold (``>=``), the retrain path's metric set."""
    ev = _eval_frame(spark, sf_dir)
    t = M.best_f1_threshold(ev, "score4", "Churn_binary").select("threshold").scalar()
    return M.threshold_metrics(ev, "score4", "Churn_binary", t)


# ------------------------------------------------------------ W4 / E12
_CURVE_UPLIFT_SQL = AB_SQL + """,
cu AS (
  SELECT user_id, uplift_score,
    SUM(1) OVER w AS position,
    SUM(treated) OVER w AS n_t, SUM(1 - treated) OVER w AS n_c,
    SUM((1 - churned) * treated) OVER w AS y_t, SUM((1 - churned) * (1 - treated)) OVER w AS y_c
  FROM ab WINDOW w AS (ORDER BY uplift_score DESC, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
cu2 AS (
  SELECT user_id, uplift_score, CAST(position AS BIGINT) AS position,
    (CASE WHEN n_t > 0 THEN y_t * 1.0e0 / n_t ELSE 0.0e0 END)
    - (CASE WHEN n_c > 0 THEN y_c * 1.0e0 / n_c ELSE 0.0e0 END) AS curve
  FROM cu
)"""


def _uplift_curve(spark, sf_dir):
    ab = _ab_scored(spark, sf_dir).withColumn("retained", 1 - F.col("churned"))
    return U.uplift_curve(ab, "uplift_score", "treated", "retained", "user_id")


@query("uplift_curve", _CURVE_UPLIFT_SQL + "\nSELECT * FROM cu2",
       doubles=("uplift_score", "curve"))
def uplift_curve(spark, sf_dir):
    """Cumulative retention-rate difference in uplift order."""
    return _uplift_curve(spark, sf_dir).select("user_id", "uplift_score", "position", "curve")


@query("auuc", _CURVE_UPLIFT_SQL + """
SELECT (sum(curve) - ((SELECT curve FROM cu2 WHERE position = 1)
                      + (SELECT curve FROM cu2 WHERE position = (SELECT max(position) FROM cu2))) / 2.0e0)
       / max(position) AS auuc, max(position) AS n FROM cu2""", doubles=("auuc",))
def auuc(spark, sf_dir):
    """Trapezoid area under the uplift curve / n."""
    return U.auuc(_uplift_curve(spark, sf_dir))


# ------------------------------------------------------------ R3, W6, W8, W9, C1


@query("segment_actions", BS_SQL + """
SELECT user_id, segment,
  CASE segment WHEN 'Persuadable' THEN 'Send voucher 20%' WHEN 'Sleeping_Dog' THEN 'Do NOT contact'
    WHEN 'Lost_Cause' THEN 'Escalate to CS team' WHEN 'Sure_Thing' THEN 'No action needed'
    ELSE 'Unknown' END AS recommended_action,
  CASE segment WHEN 'Persuadable' THEN 'HIGH' WHEN 'Sleeping_Dog' THEN 'SUPPRESS'
    WHEN 'Lost_Cause' THEN 'LOW' ELSE 'NONE' END AS priority FROM bs""")
def segment_actions(spark, sf_dir):
    """R3 via a broadcast dimension join."""
    bs = batch_scores(features_table(spark, sf_dir, with_high_value=False))
    return D.segment_actions(bs).select("user_id", "segment", "recommended_action", "priority")


@query("top_churn_risk", BS_SQL + """
SELECT user_id, churn_probability, uplift_score, segment FROM bs
ORDER BY churn_probability DESC, user_id LIMIT 10""", doubles=("churn_probability", "uplift_score"))
def top_churn_risk(spark, sf_dir):
    """The ten highest-risk customers (the limit is the report)."""
    bs = batch_scores(features_table(spark, sf_dir, with_high_value=False))
    return R.top_k(bs.select("user_id", "churn_probability", "uplift_score", "segment"), 10,
                   [F.desc("churn_probability"), F.asc("user_id")])


@query("arg_extremes", EVAL_SQL + """
SELECT (SELECT customerID FROM scu ORDER BY score4 DESC, customerID LIMIT 1) AS highest_id,
       (SELECT customerID FROM scu ORDER BY score4 ASC, customerID LIMIT 1) AS lowest_id,
       (SELECT customerID FROM scu ORDER BY abs(score4 - 0.5), customerID LIMIT 1) AS nearest_mid_id""")
def arg_extremes(spark, sf_dir):
    """Highest, lowest and most borderline customers."""
    return R.arg_extremes(_eval_frame(spark, sf_dir), "customerID", "score4")


@query("latest_event_per_user", """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1""", doubles=("value",))
def latest_event_per_user(spark, sf_dir):
    """Most recent row per key via max_by (partial aggregate)."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return R.latest_per_key(ev, ["user_id"], "ts", tie="event_id")


@query("risk_light_counts", BS_SQL + """
SELECT CASE WHEN churn_probability > 0.7 THEN 'red' WHEN churn_probability > 0.4 THEN 'amber'
            ELSE 'green' END AS light, count(*) AS n FROM bs GROUP BY 1""")
def risk_light_counts(spark, sf_dir):
    """C1 traffic light over the score table."""
    bs = batch_scores(features_table(spark, sf_dir, with_high_value=False))
    return bs.groupBy(risk_light(F.col("churn_probability")).alias("light")).agg(
        F.count(F.lit(1)).alias("n"))
