"""Registered survival queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import sql_checks as S
from .queries import query
from .queries_analytics import _eval_frame
from .retention import batch_scores, features_table
from ..operators import survival as SV

SURV_COVARIATES = ("Contract_encoded", "MonthlyCharges", "InternetService_encoded", "SeniorCitizen",
                   "service_count", "digital_engagement")
# the leaky tenure-derived covariate is opt-in
SURV_COVARIATES_PARITY = SURV_COVARIATES + ("charge_per_month",)


def _features(spark, sf_dir):
    return features_table(spark, sf_dir, with_high_value=False)


@query("km_by_contract", S.with_(*S.FEATURE_CHAIN, """
kc AS (SELECT Contract_encoded, CAST(tenure AS DOUBLE) AS t, count(*) AS removed,
              CAST(sum(Churn_binary) AS BIGINT) AS events FROM feat GROUP BY 1, 2),
kr AS (SELECT *, CAST(sum(removed) OVER (PARTITION BY Contract_encoded)
        - coalesce(sum(removed) OVER (PARTITION BY Contract_encoded ORDER BY t
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at_risk FROM kc),
kr2 AS (SELECT *,
        CASE WHEN events < at_risk THEN -ln(1.0e0 - events * 1.0e0 / at_risk) ELSE 0.0e0 END AS nlog,
        CASE WHEN events < at_risk THEN 0 ELSE 1 END AS zero,
        CASE WHEN events < at_risk THEN events * 1.0e0 / (at_risk * (at_risk - events)) ELSE 0.0e0 END AS gw
        FROM kr),
kr3 AS (SELECT *,
        sum(nlog) OVER w AS cl, sum(zero) OVER w AS cz, sum(gw) OVER w AS greenwood
        FROM kr2 WINDOW w AS (PARTITION BY Contract_encoded ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
kr4 AS (SELECT *, CASE WHEN cz > 0 THEN 0.0e0 ELSE exp(-cl) END AS survival FROM kr3)""") + """
SELECT Contract_encoded, t, at_risk, events, removed - events AS censored, survival, greenwood,
  CASE WHEN survival > 0 AND survival < 1 THEN
    exp(-exp(ln(-ln(survival)) - 1.959963984540054e0 * sqrt(greenwood) / ln(survival))) END AS ci_lower,
  CASE WHEN survival > 0 AND survival < 1 THEN
    exp(-exp(ln(-ln(survival)) + 1.959963984540054e0 * sqrt(greenwood) / ln(survival))) END AS ci_upper
FROM kr4""", doubles=("t", "survival", "greenwood", "ci_lower", "ci_upper"))
def km_by_contract(spark, sf_dir):
    """E5: Kaplan–Meier curves by contract type."""
    return SV.kaplan_meier(_features(spark, sf_dir), "tenure", "Churn_binary", "Contract_encoded")


_LOGRANK_SQL = S.with_(*S.FEATURE_CHAIN, """
lr AS (SELECT CAST(tenure AS DOUBLE) AS t, Churn_binary AS e,
              CASE WHEN Contract_encoded = 0 THEN 1 ELSE 0 END AS in_a
       FROM feat WHERE Contract_encoded IN (0, 1)),
lp AS (SELECT t, count(*) AS rem, sum(in_a) AS rem_a, sum(e) AS d, sum(e * in_a) AS d_a FROM lr GROUP BY t),
lq AS (SELECT *, (SELECT count(*) FROM lr) - coalesce(sum(rem) OVER w, 0) AS n,
              (SELECT sum(in_a) FROM lr) - coalesce(sum(rem_a) OVER w, 0) AS na
       FROM lp WINDOW w AS (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ls AS (SELECT CAST(sum(d_a) AS DOUBLE) AS observed_a, sum(d * na * 1.0e0 / n) AS expected_a,
              sum(CASE WHEN n > 1 THEN d * (na * 1.0e0 / n) * (1 - na * 1.0e0 / n) * (n - d) / (n - 1)
                  ELSE 0.0e0 END) AS variance FROM lq)""")


@query("logrank_contract", _LOGRANK_SQL + """
SELECT '0' AS group_a, '1' AS group_b, observed_a, expected_a, variance,
       pow(observed_a - expected_a, 2) / variance AS chi2 FROM ls""",
       doubles=("observed_a", "expected_a", "variance", "chi2"))
def logrank_contract(spark, sf_dir):
    """E6 statistic: month-to-month vs one-year contracts."""
    return SV.logrank(_features(spark, sf_dir), "tenure", "Churn_binary", "Contract_encoded", 0, 1
                      ).drop("p_value")


@query("logrank_test")
def logrank_test(spark, sf_dir):
    """E6 with its χ²(1) p-value (erfc has no SQL-oracle form)."""
    return SV.logrank(_features(spark, sf_dir), "tenure", "Churn_binary", "Contract_encoded", 0, 2)


@query("concordance_index", S.with_(*S.FEATURE_CHAIN, S.SCORES, """
ce AS (SELECT CAST(tenure AS DOUBLE) AS t, Churn_binary AS e, -score4 AS s FROM scu)""") + """
SELECT CAST(sum(CASE WHEN j.s > i.s THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       CAST(sum(CASE WHEN j.s = i.s THEN 1 ELSE 0 END) AS BIGINT) AS tied,
       CAST(count(*) AS BIGINT) AS pairs,
       (sum(CASE WHEN j.s > i.s THEN 1 ELSE 0 END) + sum(CASE WHEN j.s = i.s THEN 1 ELSE 0 END) / 2.0e0)
         / count(*) AS c_index
FROM ce i JOIN ce j ON i.e = 1 AND (j.t > i.t OR (j.t = i.t AND j.e = 0))""", doubles=("c_index",))
def concordance_index(spark, sf_dir):
    """C-index of the fixed risk score (higher risk = shorter survival)."""
    ev = _eval_frame(spark, sf_dir).withColumn("neg_risk", -F.col("score4"))
    return SV.concordance_index(ev, "tenure", "Churn_binary", "neg_risk")


def _cox(spark, sf_dir, covariates=SURV_COVARIATES):
    return SV.cox_fit(_features(spark, sf_dir), "tenure", "Churn_binary", covariates, penalizer=0.1)


@query("cox_summary")
def cox_summary(spark, sf_dir):
    """Penalised Cox fit – coefficient, hazard ratio, se, z, p."""
    return _cox(spark, sf_dir)["summary"]


@query("hazard_report")
def hazard_report(spark, sf_dir):
    """Significant covariates and the direction of their effect, of the fit
    with the tenure-derived charge per month, the covariate that has one here."""
    return SV.hazard_report(_cox(spark, sf_dir, SURV_COVARIATES_PARITY)["summary"])


@query("survival_at_horizons")
def survival_at_horizons(spark, sf_dir):
    """P(active) at 7 / 30 / 90 months for every customer."""
    feats = _features(spark, sf_dir)
    fit = _cox(spark, sf_dir)
    return SV.survival_at(feats, fit).select("customerID", "p_active_7", "p_active_30", "p_active_90")


@query("batch_scores_with_survival")
def batch_scores_with_survival(spark, sf_dir):
    """R8 with E10: expected remaining tenure from the fitted Cox model."""
    feats = _features(spark, sf_dir)
    fit = _cox(spark, sf_dir)
    rem = SV.expected_remaining(feats, fit)
    return batch_scores(rem, remaining=F.col("expected_tenure_remaining"))


@query("cox_concordance")
def cox_concordance(spark, sf_dir):
    """E8 on the fitted Cox model: concordance of −partial hazard."""
    feats = _features(spark, sf_dir)
    fit = _cox(spark, sf_dir)
    scored = feats.withColumn("neg_hazard", -SV.partial_hazard(fit))
    return SV.concordance_index(scored, "tenure", "Churn_binary", "neg_hazard")
