"""Registered sink, registry and streaming queries (S1, S5–S10, S12, M10–M14, C3, C4, §2.9).

Each query writes into a fresh folder under the shared checkpoint directory
and returns what it reads back, so the check covers the write path too.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from . import sql_checks as S
from .queries import ORACLES, query
from .queries_analytics import _eval_frame
from .retention import batch_scores, features_table, targeting
from ..functions.features import round_half_even
from ..operators import drift as DR
from ..operators import metrics as M
from ..operators import profile as P
from ..operators import registry as RG
from ..operators import survival as SV
from ..session import stable
from ..sources import io as IO
from ..sources.bridge import customers_raw
from ..sources.tables import read_table
from ..streaming.incremental import RAW_SCHEMA, run_incremental_scoring

def _week():
    return F.expr("CAST(substring(user_id, 2) AS BIGINT)") % 8 + 1
_WEEK_SQL = "(CAST(substring(user_id, 2) AS BIGINT) % 8 + 1)"
_RAW_COLS = [f.name for f in RAW_SCHEMA.fields]


@query("csv_roundtrip_customers", S.with_(S.CUSTOMERS_RAW) + f"SELECT {', '.join(_RAW_COLS)} FROM customers_raw",
       doubles=("monthly_charges",))
def csv_roundtrip_customers(spark, sf_dir):
    """S5 then S1: raw customers written as CSV and read back with an explicit
    schema (the blank total is kept as text)."""
    path = IO.work_dir(spark, "csv")
    raw = customers_raw(spark, sf_dir)
    (raw.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return IO.read_csv(spark, path, RAW_SCHEMA)


def _batch_times(spark, sf_dir):
    """Latest order time and one day later, as timezone-free scalar columns."""
    t1 = read_table(spark, sf_dir, "orders").agg(F.max("o_orderdate")).scalar()
    return t1, t1 + F.expr("INTERVAL 1 DAY")


def _batch_start(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").agg(F.max("o_orderdate")).first()[0]


@query("upsert_scores", S.with_(*S.SCORE_CHAIN, """
t AS (SELECT max(o_orderdate) AS t1, max(o_orderdate) + INTERVAL 1 DAY AS t2 FROM orders),
b1 AS (SELECT user_id, churn_probability, segment, t.t1 AS scored_at FROM bs, t WHERE """ + _WEEK_SQL + """ <= 6),
b2 AS (SELECT customerID AS user_id, round_even(p_treated * 10000.0e0, 0) / 10000.0e0 AS churn_probability,
              'rescored' AS segment, t.t2 AS scored_at FROM scu, t
       WHERE (CAST(substring(customerID, 2) AS BIGINT) % 8 + 1) >= 5)""") + """
SELECT b2.user_id, b2.churn_probability, b2.segment, b2.scored_at, coalesce(b1.scored_at, b2.scored_at) AS created_at
FROM b2 LEFT JOIN b1 USING (user_id)
UNION ALL
SELECT b1.user_id, b1.churn_probability, b1.segment, b1.scored_at, b1.scored_at FROM b1
WHERE b1.user_id NOT IN (SELECT user_id FROM b2)""", doubles=("churn_probability",))
def upsert_scores(spark, sf_dir):
    """Two overlapping score batches merged on user_id; updated rows keep
    their first created_at."""
    t1, t2 = _batch_times(spark, sf_dir)
    feats = features_table(spark, sf_dir, with_high_value=False)
    bs = batch_scores(feats)
    b1 = bs.where(_week() <= 6).select("user_id", "churn_probability", "segment",
                                     t1.alias("scored_at"))
    from ..functions.scoring import retention_scores
    s2 = retention_scores(feats).select(F.col("customerID").alias("user_id"), "p_treated")
    b2 = s2.where(_week() >= 5).select("user_id", round_half_even("p_treated", 4).alias("churn_probability"),
                                     F.lit("rescored").alias("segment"),
                                     t2.alias("scored_at"))
    path = IO.work_dir(spark, "scores")
    IO.upsert(b1, path, "user_id", "scored_at", now=F.col("scored_at"))
    return IO.upsert(b2, path, "user_id", "scored_at", now=F.col("scored_at"))


@query("insert_ignore_customers", S.with_(S.CUSTOMERS_RAW, """
t AS (SELECT max(o_orderdate) AS t1, max(o_orderdate) + INTERVAL 1 DAY AS t2 FROM orders),
e AS (SELECT customer_id, contract, tenure, t.t1 AS loaded_at FROM customers_raw, t
      WHERE (CAST(substring(customer_id, 2) AS BIGINT) % 8 + 1) <= 6),
i AS (SELECT customer_id, contract, tenure + 1 AS tenure, t.t2 AS loaded_at FROM customers_raw, t)""") + """
SELECT * FROM e UNION ALL SELECT * FROM i WHERE customer_id NOT IN (SELECT customer_id FROM e)""")
def insert_ignore_customers(spark, sf_dir):
    """S7 (J6): a second load inserts only customers not present yet."""
    t1, t2 = _batch_times(spark, sf_dir)
    raw = customers_raw(spark, sf_dir).select("customer_id", "contract", "tenure")
    wk = F.expr("CAST(substring(customer_id, 2) AS BIGINT)") % 8 + 1
    e = raw.where(wk <= 6).withColumn("loaded_at", t1)
    i = raw.withColumn("tenure", F.col("tenure") + 1).withColumn("loaded_at", t2)
    path = IO.work_dir(spark, "customers")
    IO.insert_ignore(e, path, "customer_id", "loaded_at")
    return IO.insert_ignore(i, path, "customer_id", "loaded_at")


@query("insert_missing_keys", S.with_(S.CUSTOMERS_RAW, """
pos AS (SELECT *, row_number() OVER (ORDER BY customer_id) - 1 AS p FROM customers_raw)""") + """
SELECT CASE WHEN CAST(substring(customer_id, 2) AS BIGINT) % 3 = 0 THEN printf('CUST_%05d', p) ELSE customer_id END AS customer_id,
       contract, tenure, customer_id AS source_row FROM pos""")
def insert_missing_keys(spark, sf_dir):
    """A load in which every third key is missing; such rows get a key made of
    their position in the load's order, and the same load again inserts nothing."""
    raw = customers_raw(spark, sf_dir).select("customer_id", "contract", "tenure", F.col("customer_id").alias("source_row"))
    third = F.expr("CAST(substring(source_row, 2) AS BIGINT)") % 3 == 0
    load = raw.withColumn("customer_id", F.when(~third, F.col("customer_id")))
    path = IO.work_dir(spark, "keyless")
    IO.insert_ignore(load, path, "customer_id", "source_row")
    return IO.insert_ignore(load, path, "customer_id", "source_row")


@query("plan_audit", f"""
SELECT (SELECT count(*) FROM ({ORACLES['action_plan']}) p) AS plan_users, count(*) AS targeted_users,
       CAST(coalesce(sum(action_cost), 0) AS BIGINT) AS total_cost, coalesce(sum(expected_clv_saved), 0.0e0) AS total_clv_saved
FROM ({ORACLES['retention_targeting']}) targeted""", doubles=("total_clv_saved",))
def plan_audit(spark, sf_dir):
    """Rows and totals of the action plan and of the targeted list."""
    return P.plan_audit(*targeting(spark, sf_dir))


@query("action_log_append", f"""
SELECT recommended_action, CAST(2 * count(*) AS BIGINT) AS logged
FROM ({ORACLES['retention_targeting']}) targeted GROUP BY recommended_action""")
def action_log_append(spark, sf_dir):
    """S8 + S10: the targeted list appended to the action log on two runs."""
    _, within = targeting(spark, sf_dir)
    rows = within.select("user_id", "segment", "recommended_action", "action_cost", "expected_clv_saved",
                         "roi", "churn_probability")
    path = IO.work_dir(spark, "action_logs")
    name = f"action_logs_{path.rstrip('/').rsplit('/', 1)[-1]}"
    IO.create_if_absent(spark, name, "user_id string, segment string, recommended_action string, "
                        "action_cost int, expected_clv_saved double, roi double, churn_probability double, "
                        "executed_at timestamp, log_date date", path)
    IO.append_log(rows, path)
    IO.append_log(rows, path)
    spark.catalog.refreshTable(name)
    return spark.table(name).groupBy("recommended_action").agg(F.count(F.lit(1)).alias("logged"))


@query("drift_summary_json", ORACLES["drift_summary"])
def drift_summary_json(spark, sf_dir):
    """The drift summary written as a one-record JSON file and read back."""
    from .queries_drift import _halves
    at = read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    summ = DR.drift_summary(DR.dataset_drift(_halves(spark, sf_dir)), at=at)
    path = IO.work_dir(spark, "drift")
    IO.write_summary(summ, path)
    return IO.read_summary(spark, path, summ.schema)


@query("table_fingerprint")
def table_fingerprint(spark, sf_dir):
    """Order-insensitive fingerprint of lineitem, recorded then validated."""
    li = read_table(spark, sf_dir, "lineitem")
    path = IO.join_path(IO.work_dir(spark, "fingerprints"), "lineitem")
    IO.record_fingerprint(li, path)
    ok = IO.validate_fingerprint(li, path)
    return IO.fingerprint(li).withColumn("validated", F.lit(ok))


# ------------------------------------------------------------------ registry


def _registry(spark, sf_dir):
    """Log this data's three model families, register two churn versions and
    run champion/challenger."""
    reg = RG.Registry(spark, IO.work_dir(spark, "registry"))
    ev = _eval_frame(spark, sf_dir)
    auc = M.roc_auc(ev, "score4", "Churn_binary").first()["auc"]
    f1 = M.best_f1_threshold(ev, "score4", "Churn_binary").first()["f1"]
    cidx = SV.concordance_index(ev.withColumn("neg_risk", -F.col("score4")), "tenure", "Churn_binary",
                                "neg_risk").first()["c_index"]
    t1 = _batch_start(spark, sf_dir)
    r1 = reg.log_run("lightgbm_baseline", {"model": "fixed_logistic"}, {"auc_roc": auc, "f1": f1},
                     {"promoted": "true", "data_commit": "0123456789abcdef"}, start_time=t1)
    v1 = reg.register_model(r1)
    reg.champion_challenger(v1, auc)
    reg.log_run("coxph_survival", {}, {"c_index": cidx}, {"promoted": "true"}, start_time=t1)
    # a weaker challenger: tenure alone as the risk score
    ev2 = ev.withColumn("tenure_risk", -F.col("tenure").cast("double"))
    auc2 = M.roc_auc(ev2, "tenure_risk", "Churn_binary").first()["auc"]
    r2 = reg.log_run("lightgbm_tenure_only", {"model": "tenure"}, {"auc_roc": auc2},
                     {"promoted": "false"}, start_time=t1 + timedelta(hours=1))
    v2 = reg.register_model(r2)
    promoted = reg.champion_challenger(v2, auc2)
    reg.set_tag(r2, "promoted", str(promoted).lower())
    return reg


@query("registry_summary")
def registry_summary(spark, sf_dir):
    """M10–M12 (J4): versions with metrics, data commit and current aliases."""
    return _registry(spark, sf_dir).summary()


@query("run_table")
def run_table(spark, sf_dir):
    """Model family, score and status of every logged run."""
    return RG.run_table(_registry(spark, sf_dir).current_runs())


@query("champion_deltas")
def champion_deltas(spark, sf_dir):
    """F7 + W9 + C4: latest promoted run per metric and its delta to the baseline."""
    return RG.baseline_deltas(RG.champions(_registry(spark, sf_dir).current_runs()))


@query("gated_retrain")
def gated_retrain(spark, sf_dir):
    """M14 (+S12, M13): the drift check's result is the flag that gates the retrain, and
    the fingerprint recorded before training must still match.  Asked for two
    pairs of populations, customers of weeks 1–4 against 5–8 and those of up to 24
    months against the others, then once more with the flag cleared: a row each with
    the drift score, the flag, whether a model was trained and its hold-out AUC."""
    from .queries_drift import _halves
    from ..functions.features import FEATURE_COLS
    base = IO.work_dir(spark, "retrain")
    flag = IO.join_path(base, "drift_flag")
    feats = stable(features_table(spark, sf_dir))
    fp = IO.join_path(base, "features_fingerprint")
    IO.record_fingerprint(feats, fp)
    reg = RG.Registry(spark, IO.join_path(base, "registry"))
    new, old = feats.where("tenure <= 24"), feats.where("tenure > 24")
    checks = [("weeks", _halves(spark, sf_dir)), ("tenure", DR.column_drift(new, old, DR.common_columns(new, old)))]
    out = []
    for name, drift in checks:
        found = DR.dataset_drift(drift).select("drift_score", "drift_detected")
        IO.write_summary(found.select("drift_detected"), flag)
        r = found.first()
        out.append((name, r["drift_score"], r["drift_detected"], RG.gated_retrain(feats, reg, flag, fp, IO.join_path(base, "models"), FEATURE_COLS)))
    out.append(("cleared", None, 0, RG.gated_retrain(feats, reg, flag, fp, IO.join_path(base, "models"), FEATURE_COLS)))
    rows = spark.createDataFrame([(n, s, d, auc is not None, auc) for n, s, d, auc in out],
                                 "check_name string, drift_score double, drift_detected int, retrained boolean, holdout_auc double")
    return rows.withColumn("versions", reg.versions().select(F.count(F.lit(1))).scalar())


# ------------------------------------------------------------------ streaming


@query("streaming_scores", S.with_(*S.SCORE_CHAIN) + """
SELECT user_id, churn_probability, churn_predicted, uplift_score, segment, clv_proxy FROM bs""",
       doubles=("churn_probability", "uplift_score", "clv_proxy"))
def streaming_scores(spark, sf_dir):
    """§2.9: raw customers arrive as two file drops; a Structured Streaming
    query scores them and upserts each micro-batch into the score table."""
    base = IO.work_dir(spark, "stream")
    src, tgt, ck = (IO.join_path(base, x) for x in ("incoming", "scores", "checkpoint"))
    raw = customers_raw(spark, sf_dir)
    wk = F.expr("CAST(substring(customer_id, 2) AS BIGINT)") % 8 + 1
    raw.where(wk <= 4).write.mode("append").parquet(src)
    raw.where(wk > 4).write.mode("append").parquet(src)
    run_incremental_scoring(spark, src, tgt, ck)
    return IO.read_current(spark, tgt).select("user_id", "churn_probability", "churn_predicted",
                                              "uplift_score", "segment", "clv_proxy")


@query("streaming_events", S.with_(*S.SCORE_CHAIN, """
t AS (SELECT max(o_orderdate) AS t0 FROM orders)""") + """
SELECT user_id, churn_probability, segment,
       t0 + (CAST(substring(user_id, 2) AS BIGINT) % 5) * INTERVAL 1 HOUR AS scored_at FROM bs, t""",
       doubles=("churn_probability",))
def streaming_events(spark, sf_dir):
    """§2.9 with event time: three file drops, the second with earlier events of all
    customers, the third with the first's events delivered again.  The table
    must hold each customer's newest event once.  A drop is as many files as Spark writes
    it in, never one task's; the stream takes it up as one batch, from its checkpoint."""
    base = IO.work_dir(spark, "events")
    src, tgt, ck = (IO.join_path(base, x) for x in ("incoming", "scores", "checkpoint"))
    at = F.lit(_batch_start(spark, sf_dir)).cast("timestamp")
    hours = F.expr("make_interval(0, 0, 0, 0, CAST(CAST(substring(customer_id, 2) AS BIGINT) % 5 AS INT))")
    raw = customers_raw(spark, sf_dir).withColumn("event_time", at + hours)
    early = raw.withColumns({"event_time": F.col("event_time") - F.expr("INTERVAL 6 HOURS"), "contract": F.lit("Two year")})
    for drop in (raw, early, raw):
        drop.write.mode("append").parquet(src)
        run_incremental_scoring(spark, src, tgt, ck, event_time="event_time")
    return IO.read_current(spark, tgt).select("user_id", "churn_probability", "segment", "scored_at")
