"""Registered drift queries (S11, D1o–D4o)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import sql_checks as S
from .queries import query
from .retention import features_table
from ..operators import drift as DR
from ..sources.tables import read_table

DRIFT_DOUBLES = ("ks_stat", "ks_p_value", "wasserstein_normed", "js_distance", "psi")


def _weekly_features(spark, sf_dir):
    f = features_table(spark, sf_dir, with_high_value=False)
    return f.withColumn("week", (F.expr("CAST(substring(customerID, 2) AS BIGINT)") % 8 + 1).cast("int"))


def _drift_sql(ref_where: str, cur_where: str, grp_expr: str) -> str:
    cols = DR.DRIFT_COLUMNS
    rs = " UNION ALL ".join(f"SELECT '{c}' AS col_name, CAST({c} AS DOUBLE) AS v FROM featw WHERE {ref_where}"
                            for c in cols)
    cs = " UNION ALL ".join(f"SELECT {grp_expr} AS grp, '{c}' AS col_name, CAST({c} AS DOUBLE) AS v "
                            f"FROM featw WHERE {cur_where}" for c in cols)
    return S.with_(*S.FEATURE_CHAIN, f"""
featw AS (SELECT *, CAST(CAST(substring(customerID, 2) AS BIGINT) % 8 + 1 AS INTEGER) AS week FROM feat),
rs AS ({rs}),
cs AS ({cs}),
grps AS (SELECT DISTINCT grp FROM cs),
cnt AS (
  SELECT grp, col_name, v, CAST(sum(nr) AS BIGINT) AS nr, CAST(sum(nc) AS BIGINT) AS nc FROM (
    SELECT g.grp, r.col_name, r.v, 1 AS nr, 0 AS nc FROM rs r, grps g
    UNION ALL SELECT grp, col_name, v, 0, 1 FROM cs) u
  WHERE v IS NOT NULL GROUP BY 1, 2, 3),
tot AS (SELECT grp, col_name, sum(nr) AS N_r, sum(nc) AS N_c, count(*) AS n_unique FROM cnt GROUP BY 1, 2),
rng AS (SELECT grp, col_name, min(CASE WHEN nr > 0 THEN v END) AS ref_min,
               max(CASE WHEN nr > 0 THEN v END) AS ref_max FROM cnt GROUP BY 1, 2),
cdf AS (
  SELECT c.*, t.N_r, t.N_c, t.n_unique, g.ref_min, g.ref_max,
    sum(c.nr) OVER w * 1.0e0 / t.N_r AS fr, sum(c.nc) OVER w * 1.0e0 / t.N_c AS fc,
    lead(c.v) OVER (PARTITION BY c.grp, c.col_name ORDER BY c.v) AS v_next,
    c.nr * 1.0e0 / t.N_r AS pr, c.nc * 1.0e0 / t.N_c AS pc
  FROM cnt c JOIN tot t USING (grp, col_name) JOIN rng g USING (grp, col_name)
  WINDOW w AS (PARTITION BY c.grp, c.col_name ORDER BY c.v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
mom AS (SELECT col_name, stddev_pop(v) AS ref_std FROM rs GROUP BY 1),
agg AS (
  SELECT grp, col_name, N_r, N_c, n_unique, max(abs(fr - fc)) AS ks_stat,
    sum(CASE WHEN v_next IS NOT NULL THEN abs(fr - fc) * (v_next - v) ELSE 0.0e0 END) AS wasserstein,
    sum(0.5e0 * (CASE WHEN pr > 0 THEN pr * ln(pr / ((pr + pc) / 2)) ELSE 0.0e0 END)
        + 0.5e0 * (CASE WHEN pc > 0 THEN pc * ln(pc / ((pr + pc) / 2)) ELSE 0.0e0 END)) AS js_divergence
  FROM cdf GROUP BY 1, 2, 3, 4, 5),
binned AS (
  SELECT grp, col_name, N_r, N_c, nr, nc,
    CASE WHEN (ref_max - ref_min) / 10 > 0 THEN CAST(least(9, greatest(0, floor((v - ref_min) / ((ref_max - ref_min) / 10)))) AS INTEGER)
         ELSE 0 END AS bin FROM cdf),
psi AS (
  SELECT grp, col_name, sum((bc - br) * ln(bc / br)) AS psi FROM (
    SELECT grp, col_name, greatest(sum(nr) * 1.0e0 / max(N_r), 0.0001e0) AS br,
           greatest(sum(nc) * 1.0e0 / max(N_c), 0.0001e0) AS bc
    FROM binned GROUP BY grp, col_name, bin) b GROUP BY 1, 2),
res AS (
  SELECT a.*, p.psi, m.ref_std, (sqrt(a.N_r * a.N_c * 1.0e0 / (a.N_r + a.N_c)) + 0.12e0
         + 0.11e0 / sqrt(a.N_r * a.N_c * 1.0e0 / (a.N_r + a.N_c))) * a.ks_stat AS lam
  FROM agg a JOIN psi p USING (grp, col_name) JOIN mom m USING (col_name)),
res2 AS (
  SELECT *, least(1.0e0, greatest(0.0e0, CASE
      WHEN lam <= 0 THEN 1.0e0
      WHEN lam < 1.18 THEN 1.0e0 - sqrt(2 * pi()) / lam
           * (SELECT sum(exp(-pow(2.0e0 * k - 1, 2) * pow(pi(), 2) / (8.0e0 * lam * lam))) FROM range(1, 101) r(k))
      ELSE 2.0e0 * (SELECT sum(pow(-1.0e0, k - 1) * exp(-2.0e0 * k * k * lam * lam)) FROM range(1, 101) r(k))
    END)) AS ks_p_value,
    CASE WHEN ref_std > 0 THEN wasserstein / ref_std ELSE wasserstein END AS wasserstein_normed,
    sqrt(greatest(js_divergence, 0.0e0)) AS js_distance,
    CASE WHEN col_name IN ('SeniorCitizen', 'Contract_encoded', 'InternetService_encoded')
         THEN 'jensenshannon' ELSE 'wasserstein' END AS stattest
  FROM res),
col_drift AS (
  SELECT grp AS "group", col_name, CAST(N_r AS BIGINT) AS n_ref, CAST(N_c AS BIGINT) AS n_cur,
    CAST(n_unique AS BIGINT) AS n_unique, ks_stat, ks_p_value, wasserstein_normed, js_distance, psi, stattest,
    CASE WHEN stattest = 'ks' THEN CAST(ks_p_value < 0.05 AS INTEGER)
         WHEN stattest = 'wasserstein' THEN CAST(wasserstein_normed >= 0.1 AS INTEGER)
         ELSE CAST(js_distance >= 0.1 AS INTEGER) END AS drifted
  FROM res2)""")


_HALVES = _drift_sql("week <= 4", "week >= 5", "'all'")
_WEEKLY = _drift_sql("week = 1", "week >= 2", "CAST(week AS VARCHAR)")


def _halves(spark, sf_dir):
    f = _weekly_features(spark, sf_dir)
    ref, cur = f.where(F.col("week") <= 4), f.where(F.col("week") >= 5)
    return DR.column_drift(ref, cur, DR.common_columns(ref, cur))


@query("column_drift", _HALVES + "SELECT * FROM col_drift", doubles=DRIFT_DOUBLES)
def column_drift(spark, sf_dir):
    """D1o + S11: per-column drift, customers of weeks 1–4 vs weeks 5–8."""
    return _halves(spark, sf_dir)


_DS_SQL = """
ds AS (SELECT "group", CAST(sum(drifted) AS BIGINT) AS n_drifted_columns, count(*) AS n_total_columns,
              sum(drifted) * 1.0e0 / count(*) AS drift_score, 0.3e0 AS threshold FROM col_drift GROUP BY 1)"""


@query("dataset_drift", _HALVES + "," + _DS_SQL + """
SELECT *, CAST(drift_score >= threshold AS INTEGER) AS drift_detected FROM ds""",
       doubles=("drift_score", "threshold"))
def dataset_drift(spark, sf_dir):
    """D2o: share of drifted columns against the 0.3 threshold."""
    return DR.dataset_drift(_halves(spark, sf_dir))


@query("drift_summary", _HALVES + "," + _DS_SQL + """
SELECT strftime((SELECT max(o_orderdate) FROM orders), '%Y%m%d_%H%M%S') AS timestamp, drift_score,
       n_drifted_columns, n_total_columns, CAST(drift_score >= threshold AS INTEGER) AS drift_detected,
       threshold FROM ds""", doubles=("drift_score", "threshold"))
def drift_summary(spark, sf_dir):
    """D3o: one-record summary, stamped with the data's latest order time."""
    at = read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    return DR.drift_summary(DR.dataset_drift(_halves(spark, sf_dir)), at=at)


@query("weekly_drift", _WEEKLY + "SELECT * FROM col_drift", doubles=DRIFT_DOUBLES)
def weekly_drift(spark, sf_dir):
    """D4o: weeks 2–8 each against week 1."""
    f = _weekly_features(spark, sf_dir)
    return DR.column_drift(f.where(F.col("week") == 1), f.where(F.col("week") >= 2), DR.DRIFT_COLUMNS,
                           group="week")
