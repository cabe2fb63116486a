"""Model run registry as append-only tables.

A registry is a folder with three parquet tables:
``runs``    (run_id, run_name, start_time, params, metrics, tags),
``versions`` (version, run_id, created_at),
``aliases`` (alias, version, seq) – the current alias is the latest row per
alias (``max_by`` over seq).
Rows are only appended, so concurrent readers always see a consistent
history.  All decisions are DataFrame expressions over these tables; the
driver only reads the one-row answers it needs to branch on.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import run_kind
from ..sources.io import join_path, read_summary, validate_fingerprint, write_summary

# AUC assumed for a champion without a logged AUC, the env
# default promotion floor, and the dashboard baselines per model family.
BASELINE_AUC = 0.8445
MIN_AUC_TO_PROMOTE = 0.84
DASHBOARD_BASELINES = (("AUC-ROC", 0.80), ("C-index", 0.90), ("AUUC", 0.10))
PROMOTED_VALUES = ("true", "1", "yes")

RUNS_SCHEMA = ("run_id string, run_name string, start_time timestamp, params map<string,string>, "
               "metrics map<string,double>, tags map<string,string>, revision int")
VERSIONS_SCHEMA = "version int, run_id string, created_at timestamp"
ALIASES_SCHEMA = "alias string, version int, seq long"


class Registry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _t(self, name):
        return join_path(self.path, name)

    def table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self._t(name))
        except AnalysisException:  # nothing appended yet
            return self.spark.createDataFrame([], schema)

    def runs(self):
        return self.table("runs", RUNS_SCHEMA)

    def versions(self):
        return self.table("versions", VERSIONS_SCHEMA)

    def aliases(self):
        return self.table("aliases", ALIASES_SCHEMA)

    def _append(self, name, rows, schema):
        self.spark.createDataFrame(rows, schema).write.mode("append").parquet(self._t(name))

    # M10 ---------------------------------------------------------------
    def log_run(self, run_name: str, params: dict, metrics: dict, tags: dict | None = None,
                start_time: datetime | None = None) -> str:
        rid = uuid.uuid4().hex
        self._append("runs", [(rid, run_name, start_time or datetime.now(timezone.utc).replace(tzinfo=None),
                               {k: str(v) for k, v in params.items()},
                               {k: float(v) for k, v in metrics.items()},
                               {k: str(v) for k, v in (tags or {}).items()}, 0)], RUNS_SCHEMA)
        return rid

    def set_tag(self, run_id: str, key: str, value: str) -> None:
        """A tag change is appended as the run's next revision."""
        r = self.current_runs().where(F.col("run_id") == run_id).withColumns({
            "tags": F.map_concat(F.map_filter("tags", lambda k, v: k != F.lit(key)),
                                 F.create_map(F.lit(key), F.lit(value))),
            "revision": F.col("revision") + 1})
        row = r.select(*[c.split(" ")[0] for c in RUNS_SCHEMA.split(", ") if " " in c]).first()
        self._append("runs", [tuple(row)], RUNS_SCHEMA)

    def current_runs(self) -> DataFrame:
        """Latest revision per run id."""
        r = self.runs()
        return r.groupBy("run_id").agg(F.max_by(F.struct(*[c for c in r.columns if c != "run_id"]),
                                                F.col("revision")).alias("r")).select("run_id", "r.*")

    def _next_seq(self) -> int:
        return (self.aliases().select(F.max("seq")).first()[0] or 0) + 1

    def set_alias(self, alias: str, version: int) -> None:
        self._append("aliases", [(alias, int(version), self._next_seq())], ALIASES_SCHEMA)

    def register_model(self, run_id: str, alias: str = "staging") -> int:
        v = (self.versions().select(F.max("version")).first()[0] or 0) + 1
        self._append("versions", [(v, run_id, datetime.now(timezone.utc).replace(tzinfo=None))],
                     VERSIONS_SCHEMA)
        self.set_alias(alias, v)
        return v

    def current_aliases(self) -> DataFrame:
        a = self.aliases()
        return a.groupBy("alias").agg(F.max_by("version", "seq").alias("version"))

    # M11 ---------------------------------------------------------------
    def champion_challenger(self, challenger_version: int, challenger_auc: float,
                            metric: str = "auc_roc") -> bool:
        """Promote iff the challenger's metric is strictly greater than the
        champion's (a champion without it counts as the baseline AUC); the
        loser is archived.  No champion → promote."""
        champ = (self.current_aliases().where(F.col("alias") == "champion")
                 .join(self.versions(), "version").join(self.current_runs(), "run_id")
                 .select("version", F.coalesce(F.col("metrics")[metric], F.lit(BASELINE_AUC)).alias("m"))
                 .first())
        if champ is None:
            self.set_alias("champion", challenger_version)
            return True
        if challenger_auc > champ["m"]:
            self.set_alias("archived", champ["version"])
            self.set_alias("champion", challenger_version)
            return True
        self.set_alias("archived", challenger_version)
        return False

    # M12 / J4 ------------------------------------------------------------
    def summary(self) -> DataFrame:
        """version, auc_roc, f1, data commit (8 chars), current aliases."""
        al = self.current_aliases().groupBy("version").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
        v = self.versions().join(self.current_runs(), "run_id", "left").join(al, "version", "left")
        return v.select("version",
                        F.round(F.coalesce(F.col("metrics")["auc_roc"], F.lit(0.0)), 4).alias("auc_roc"),
                        F.round(F.coalesce(F.col("metrics")["f1"], F.lit(0.0)), 4).alias("f1"),
                        F.substring(F.coalesce(F.col("tags")["data_commit"], F.lit("N/A")), 1, 8)
                        .alias("data_commit"),
                        F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"))


def run_table(runs: DataFrame) -> DataFrame:
    """Classify every run (model family from metrics / run name), its
    score, status and 8-character run id."""
    kind = run_kind(F.col("metrics"), F.col("run_name"))
    promoted = F.lower(F.coalesce(F.col("tags")["promoted"], F.lit("false"))).isin(*PROMOTED_VALUES)
    score = (F.when(kind == "AUC-ROC", F.coalesce(F.col("metrics")["auc_roc"], F.col("metrics")["auc"]))
             .when(kind == "C-index", F.col("metrics")["c_index"])
             .when(kind == "AUUC", F.col("metrics")["auuc"])
             .otherwise(F.col("metrics")[kind]))
    return runs.select(F.col("run_name").alias("model"), kind.alias("metric"),
                       F.round(F.coalesce(score, F.lit(0.0)), 4).alias("score"),
                       F.when(promoted, F.lit("Production")).otherwise(F.lit("Staging")).alias("status"),
                       F.date_format("start_time", "yyyy-MM-dd HH:mm").alias("trained"),
                       F.substring("run_id", 1, 8).alias("run_id"))


def champions(runs: DataFrame, metric_keys=("auc_roc", "c_index", "auuc")) -> DataFrame:
    """F7 + W9: per metric, the most recent promoted run that logged it."""
    promoted = F.lower(F.coalesce(F.col("tags")["promoted"], F.lit(""))).isin(*PROMOTED_VALUES)
    keyed = runs.where(promoted).select("run_id", "start_time", F.explode("metrics").alias("k", "v")) \
        .where(F.col("k").isin(*metric_keys))
    return keyed.groupBy("k").agg(F.max_by(F.struct("run_id", "v", "start_time"), "start_time").alias("c")) \
        .select(F.col("k").alias("metric"), F.substring("c.run_id", 1, 8).alias("run_id"),
                F.round("c.v", 4).alias("score"), F.date_format("c.start_time", "yyyy-MM-dd HH:mm").alias("trained"))


def baseline_deltas(champ: DataFrame) -> DataFrame:
    """C4: each champion's score minus the dashboard baseline of its family."""
    spark = champ.sparkSession
    base = F.broadcast(spark.createDataFrame(
        [("auc_roc", DASHBOARD_BASELINES[0][1]), ("c_index", DASHBOARD_BASELINES[1][1]),
         ("auuc", DASHBOARD_BASELINES[2][1])], "metric string, baseline double"))
    return champ.join(base, "metric", "left").withColumn(
        "delta", F.round(F.col("score") - F.col("baseline"), 4))


# ------------------------------------------------------------------ M13 / M14


def evaluate_champion(scored_holdout: DataFrame, label: str, threshold: float) -> DataFrame:
    """AUC, threshold metrics and the classification report of the
    champion on a scored hold-out (``churn_probability`` column)."""
    from .metrics import classification_report, roc_auc, threshold_metrics
    auc = roc_auc(scored_holdout, "churn_probability", label).select("auc")
    m = threshold_metrics(scored_holdout, "churn_probability", label, threshold, inclusive=False)
    rep = classification_report(scored_holdout.withColumn(
        "__pred", (F.col("churn_probability") > threshold).cast("int")), label, "__pred")
    return auc, m, rep


def drift_flag_set(spark: SparkSession, flag_path: str) -> bool:
    s = read_summary(spark, flag_path, "drift_detected int")
    return bool(s is not None and s.where(F.col("drift_detected") == 1).limit(1).count() > 0)


def gated_retrain(features: DataFrame, registry: Registry, flag_path: str, fingerprint_path: str,
                  model_dir: str, feature_cols, label: str = "Churn_binary",
                  min_auc: float = MIN_AUC_TO_PROMOTE, params: dict | None = None):
    """No drift flag → skip (None).  Otherwise validate the data
    fingerprint, train on a stratified split, tune the threshold on the
    hold-out, log and register the run, run champion/challenger, save the
    model and its config when promoted, and clear the flag.  Returns the
    hold-out AUC.  Registry errors propagate (SURVEY D13)."""
    from .metrics import best_f1_threshold, roc_auc, threshold_metrics
    from .models import score, stratified_split, train_boosted, with_weight
    from ..session import stable
    spark = features.sparkSession
    if not drift_flag_set(spark, flag_path):
        return None
    validate_fingerprint(features, fingerprint_path)
    f = stratified_split(features, "customerID", label)
    f = with_weight(f, label, F.col("is_test") == 0).withColumn("is_validation", F.col("is_test") == 1)
    model = train_boosted(stable(f), feature_cols, label, validation="is_validation", **(params or {}))
    test = stable(score(model, f.where(F.col("is_test") == 1)))
    auc = roc_auc(test, "churn_probability", label).first()["auc"]
    best = best_f1_threshold(test, "churn_probability", label).first()
    m = threshold_metrics(test, "churn_probability", label, best["threshold"]).first()
    run_id = registry.log_run(
        f"retrain_{datetime.now(timezone.utc):%Y%m%d_%H%M}", params or {},
        {"auc_roc": auc, "f1": m["f1"], "precision": m["precision"], "recall": m["recall"],
         "threshold": best["threshold"]})
    version = registry.register_model(run_id, "staging")
    promoted = registry.champion_challenger(version, auc)
    registry.set_tag(run_id, "promoted", str(promoted).lower())
    if promoted:
        model.save(spark, join_path(model_dir, f"churn_v{version}"))
        cfg = spark.createDataFrame(
            [(float(best["threshold"]), round(float(auc), 6), datetime.now(timezone.utc).isoformat(), run_id)],
            "churn_threshold double, auc_roc double, trained_at string, run_id string")
        write_summary(cfg, join_path(model_dir, "model_config"))
    write_summary(spark.createDataFrame([(0,)], "drift_detected int"), flag_path)  # clear
    return auc
