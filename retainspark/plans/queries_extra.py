"""Registered queries for the remaining small operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from . import sql_checks as S
from .queries import query
from .queries_analytics import AB_SQL
from .queries_drift import _WEEKLY, _weekly_features
from .retention import batch_scores, features_table
from ..functions.rules import drift_band
from ..operators import drift as DR
from ..operators import profile as P
from ..operators import survival as SV
from ..operators.ranking import nearest_lookup
from ..sources import io as IO
from ..sources.bridge import ab_outcomes

SQRT_2PI = math.sqrt(2 * math.pi)


@query("kde_tenure_by_churn", S.with_(*S.FEATURE_CHAIN, f"""
k AS (SELECT Churn_binary, CAST(tenure AS DOUBLE) AS v FROM feat),
st AS (SELECT Churn_binary, count(v) AS n, stddev_samp(v) AS sd FROM k GROUP BY 1),
rng AS (SELECT min(v) AS lo, max(v) AS hi FROM k),
d AS (SELECT Churn_binary, v, count(*) AS kk FROM k GROUP BY 1, 2),
grid AS (SELECT CAST(i AS INTEGER) AS g FROM range(0, 200) t(i)),
pts AS (SELECT d.Churn_binary, grid.g, rng.lo - (rng.hi - rng.lo) / 2 + grid.g * ((rng.hi - rng.lo) * 2 / 199.0e0) AS t,
               d.v, d.kk, st.n, st.sd * pow(st.n, -0.2e0) AS bw
        FROM d JOIN st USING (Churn_binary), grid, rng)""") + f"""
SELECT Churn_binary, g, t, sum(kk * exp(-0.5e0 * pow((t - v) / bw, 2)) / (n * bw * {SQRT_2PI!r}e0)) AS density
FROM pts GROUP BY 1, 2, 3""", doubles=("t", "density"))
def kde_tenure_by_churn(spark, sf_dir):
    """Gaussian KDE of tenure per churn label on a 200-point grid."""
    f = features_table(spark, sf_dir, with_high_value=False)
    return P.kde(f, "tenure", "Churn_binary", grid_points=200)


def _own_grid_sql(col: str) -> str:
    return S.with_(*S.FEATURE_CHAIN, f"""
d AS (SELECT Churn_binary, CAST({col} AS DOUBLE) AS v, count(*) AS kk FROM feat GROUP BY 1, 2),
st AS (SELECT Churn_binary, count({col}) AS n, stddev_samp(CAST({col} AS DOUBLE)) AS sd,
              min(CAST({col} AS DOUBLE)) AS lo, max(CAST({col} AS DOUBLE)) AS hi FROM feat GROUP BY 1),
pts AS (SELECT d.Churn_binary, CAST(i AS INTEGER) AS g, lo - (hi - lo) / 2 + i * ((hi - lo) * 2 / 999.0e0) AS t,
               d.v, d.kk, st.n, st.sd * pow(st.n, -0.2e0) AS bw
        FROM d JOIN st USING (Churn_binary), range(0, 1000) r(i))""") + f"""
SELECT Churn_binary, g, t, sum(kk * exp(-0.5e0 * pow((t - v) / bw, 2)) / (n * bw * {SQRT_2PI!r}e0)) AS density
FROM pts GROUP BY 1, 2, 3"""


@query("kde_tenure_own_grid", _own_grid_sql("tenure"), doubles=("t", "density"))
def kde_tenure_own_grid(spark, sf_dir):
    """Density of tenure, each churn label on its own grid of 1000 points."""
    return P.kde(features_table(spark, sf_dir, with_high_value=False), "tenure", "Churn_binary", 1000, own_grid=True)


@query("kde_charges_own_grid", _own_grid_sql("MonthlyCharges"), doubles=("t", "density"))
def kde_charges_own_grid(spark, sf_dir):
    """Density of monthly charges, each churn label on its own grid of 1000 points."""
    return P.kde(features_table(spark, sf_dir, with_high_value=False), "MonthlyCharges", "Churn_binary", 1000, own_grid=True)


@query("km_nearest_horizons", S.with_(*S.FEATURE_CHAIN, """
kc AS (SELECT Contract_encoded, CAST(tenure AS DOUBLE) AS t, count(*) AS removed,
              sum(Churn_binary) AS events FROM feat GROUP BY 1, 2),
kr AS (SELECT *, sum(removed) OVER (PARTITION BY Contract_encoded)
        - coalesce(sum(removed) OVER (PARTITION BY Contract_encoded ORDER BY t
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_risk FROM kc),
kr2 AS (SELECT *, CASE WHEN events < at_risk THEN -ln(1.0e0 - events * 1.0e0 / at_risk) ELSE 0.0e0 END AS nlog,
               CASE WHEN events < at_risk THEN 0 ELSE 1 END AS zero FROM kr),
kr3 AS (SELECT *, sum(nlog) OVER w AS cl, sum(zero) OVER w AS cz FROM kr2
        WINDOW w AS (PARTITION BY Contract_encoded ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
kr4 AS (SELECT *, CASE WHEN cz > 0 THEN 0.0e0 ELSE exp(-cl) END AS survival FROM kr3)""") + """
SELECT Contract_encoded,
       arg_min(survival, abs(t - 7) * 1000 + t) AS survival_at_7,
       arg_min(survival, abs(t - 30) * 1000 + t) AS survival_at_30,
       arg_min(survival, abs(t - 90) * 1000 + t) AS survival_at_90
FROM kr4 GROUP BY 1""", doubles=("survival_at_7", "survival_at_30", "survival_at_90"))
def km_nearest_horizons(spark, sf_dir):
    """W10 (E9 shape): survival at the grid point nearest to 7 / 30 / 90."""
    km = SV.kaplan_meier(features_table(spark, sf_dir, with_high_value=False), "tenure", "Churn_binary",
                         "Contract_encoded")
    return nearest_lookup(km, ["Contract_encoded"], "t", "survival", [7, 30, 90])


@query("uplift_sign_counts", AB_SQL + """
SELECT CAST(count_if(uplift_score > 0) AS BIGINT) AS positive_uplift,
       CAST(count_if(uplift_score < 0) AS BIGINT) AS negative_uplift FROM ab""")
def uplift_sign_counts(spark, sf_dir):
    """users the offer should help vs. sleeping dogs by sign of uplift."""
    ab = ab_outcomes(spark, sf_dir)
    return ab.agg(F.count_if(F.col("uplift_score") > 0).alias("positive_uplift"),
                  F.count_if(F.col("uplift_score") < 0).alias("negative_uplift"))


@query("weekly_drift_bands", _WEEKLY + """,
ds AS (SELECT "group", sum(drifted) * 1.0e0 / count(*) AS drift_score FROM col_drift GROUP BY 1)
SELECT "group", drift_score, CAST(drift_score >= 0.3 AS INTEGER) AS drift_detected,
       CASE WHEN drift_score < 0.3 THEN 'low' WHEN drift_score < 0.6 THEN 'medium' ELSE 'high' END AS band
FROM ds""", doubles=("drift_score",))
def weekly_drift_bands(spark, sf_dir):
    """D2o per week with the C2 gauge band."""
    f = _weekly_features(spark, sf_dir)
    cd = DR.column_drift(f.where(F.col("week") == 1), f.where(F.col("week") >= 2), DR.DRIFT_COLUMNS,
                         group="week")
    ds = DR.dataset_drift(cd)
    return ds.select("group", "drift_score", "drift_detected", drift_band(F.col("drift_score")).alias("band"))


@query("scores_with_fallback", S.with_(*S.SCORE_CHAIN) + """
SELECT user_id, churn_probability, segment FROM bs""", doubles=("churn_probability",))
def scores_with_fallback(spark, sf_dir):
    """Read the score table if it exists and has rows, else fall back
    to scoring from the feature pipeline (the table is absent here)."""
    missing = IO.work_dir(spark, "absent_scores")
    df = IO.coalesce_source(
        lambda: IO.read_current(spark, missing),
        lambda: batch_scores(features_table(spark, sf_dir, with_high_value=False)))
    return df.select("user_id", "churn_probability", "segment")
