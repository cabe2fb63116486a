"""Model operators on ``pyspark.ml`` (M1–M9).

* Splits are deterministic: a multiplicative integer hash of the numeric id
  (a bijection on 32 bits, so no ties) orders rows; the stratified split
  takes, per label, the first ⌈test_size·n_label⌉ rows of that order, using
  the scalable per-group running count (a label holding most rows is still
  spread over tasks).
* Boosted trees grow leaf-wise from distributed gradient histograms
  (``boosting.fit``) with a positive-class weight, feature and row subsampling
  and an early stop in the loop.  The folds of a cross-validation and the arms of
  a T-learner are grown by the same jobs.  ``train_gbt`` is ``GBTClassifier``
  with the matching parameters.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stable
from . import boosting
from .boosting import BoostedTrees
from .metrics import roc_auc
from .ranking import global_running_sum

# Training parameters of the churn model and the T-learner.
GBT_PARAMS = dict(maxDepth=5, stepSize=0.05, featureSubsetStrategy="0.9", subsamplingRate=0.8,
                  maxIter=500, minInstancesPerNode=20, seed=42)
TLEARNER_PARAMS = dict(rounds=200, rate=0.05, feature_fraction=1.0, bagging_fraction=1.0)
EARLY_STOPPING_ROUNDS = 50
CV_ROUNDS = 300
TEST_SIZE = 0.2
SEED = 42
HASH_MULTIPLIER = 2654435761
HASH_MODULUS = 4294967296


def hash_order(id_col: Column, seed: int = SEED) -> Column:
    """Deterministic pseudo-random order key of a non-negative integer id."""
    return ((id_col.cast("bigint") * F.lit(HASH_MULTIPLIER) + F.lit(seed)) % F.lit(HASH_MODULUS))


def numeric_id(col: str) -> Column:
    """Digits of an id such as 'C123' as bigint."""
    return F.regexp_extract(F.col(col), r"(\d+)", 1).cast("bigint")


def stratified_split(df: DataFrame, id_col: str, label: str, test_size: float = TEST_SIZE,
                     seed: int = SEED) -> DataFrame:
    """M1: adds ``is_test`` (1 for the held-out rows), exactly ⌈test_size·n⌉
    per label value."""
    keyed = df.withColumn("__h", hash_order(numeric_id(id_col), seed))
    ranked = global_running_sum(keyed, [F.asc("__h")], {"__pos": F.lit(1)}, partition_by=[label])
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    out = ranked.join(F.broadcast(sizes), label)  # one row per label value
    return out.withColumn("is_test", (F.col("__pos") <= F.ceil(F.col("__n") * test_size)).cast("int")
                          ).drop("__h", "__pos", "__n")


def plain_split(df: DataFrame, id_col: str, test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """M2: hash-threshold split (about ``test_size`` of rows held out)."""
    h = hash_order(numeric_id(id_col), seed)
    return df.withColumn("is_test", (h < F.lit(int(test_size * HASH_MODULUS))).cast("int"))


def fold_column(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """M6 folds: within each label, rows in hash order are dealt round-robin
    into k folds (stratified)."""
    keyed = df.withColumn("__h", hash_order(numeric_id(id_col), seed))
    ranked = global_running_sum(keyed, [F.asc("__h")], {"__pos": F.lit(1)}, partition_by=[label])
    return ranked.withColumn("fold", ((F.col("__pos") - 1) % k).cast("int")).drop("__h", "__pos")


def class_weight(df: DataFrame, label: str) -> Column:
    """M5: negatives/positives as a scalar subquery."""
    y = F.col(label)
    return df.select((F.count_if(y == 0) / F.count_if(y == 1))).scalar()


def with_weight(df: DataFrame, label: str, train_filter: Column | None = None) -> DataFrame:
    src = df.where(train_filter) if train_filter is not None else df
    w = class_weight(src, label)
    return df.withColumn("weight", F.when(F.col(label) == 1, w).otherwise(F.lit(1.0)))


def assembler(features) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def train_boosted(rows: DataFrame, features, label: str, weight: str | None = "weight",
                  validation: str | None = None, patience: int = EARLY_STOPPING_ROUNDS,
                  key: str = "customerID", **params) -> BoostedTrees:
    """M3: leaf-wise boosted trees.  With ``validation`` (a boolean column) those rows are
    held out and the model ends with its best round by their log-loss, after
    ``patience`` rounds without a better one."""
    held = F.col(validation) if validation else F.lit(False)
    return boosting.fit(rows, features, label, [~held], key, F.col(weight) if weight else None,
                        [held] if validation else None, patience if validation else None, **params)[0]


def train_gbt(train: DataFrame, features, label: str, params: dict | None = None,
              weight: str | None = "weight"):
    """Boosted trees by ``GBTClassifier`` (level-wise): assembler + GBT pipeline."""
    kw = dict(labelCol=label, featuresCol="features", **dict(GBT_PARAMS, **(params or {})))
    if weight:
        kw["weightCol"] = weight
    return Pipeline(stages=[assembler(features), GBTClassifier(**kw)]).fit(train)


def train_logistic(train: DataFrame, features, label: str, reg: float = 0.0,
                   weight: str | None = None):
    kw = dict(labelCol=label, featuresCol="features", regParam=reg, maxIter=100)
    if weight:
        kw["weightCol"] = weight
    return Pipeline(stages=[assembler(features), LogisticRegression(**kw)]).fit(train)


def score(model, df: DataFrame, out: str = "churn_probability") -> DataFrame:
    """M4: positive-class probability as a plain double column."""
    if isinstance(model, BoostedTrees):
        return df.withColumn(out, model.probability())
    return model.transform(df).withColumn(out, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def cross_validate(df: DataFrame, features, label: str, k: int = 5, id_col: str = "customerID",
                   rounds: int = CV_ROUNDS, **params) -> DataFrame:
    """M6: k-fold stratified CV of the boosted model's AUC: one row with the mean, the
    sample std and the number of folds.  The k models are grown together; each row is
    scored by the one that has not seen it."""
    folded = stable(fold_column(df, id_col, label, k))
    models = boosting.fit(folded, features, label, [F.col("fold") != i for i in range(k)], id_col, rounds=rounds, **params)
    aucs = [roc_auc(score(m, folded.where(F.col("fold") == i)), "churn_probability", label).select("auc") for i, m in enumerate(models)]
    every = aucs[0]
    for a in aucs[1:]:
        every = every.unionByName(a)
    return every.agg(F.avg("auc").alias("cv_mean_auc"), F.stddev_samp("auc").alias("cv_std_auc"), F.lit(k).alias("folds"))


def feature_importance(model: BoostedTrees) -> DataFrame:
    """M7: share of the gain and number of splits per feature, from the node table."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    names = F.array(*[F.lit(f) for f in model.features])
    nodes = model.node_table(spark).where("feature >= 0").groupBy("feature").agg(
        F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("splits"))
    every = spark.range(len(model.features)).select(F.col("id").cast("int").alias("feature"))
    total = nodes.select(F.sum("gain")).scalar()
    return every.join(F.broadcast(nodes), "feature", "left").select(  # a row per feature
        F.element_at(names, F.col("feature") + 1).alias("feature"),
        F.coalesce(F.col("gain") / total, F.lit(0.0)).alias("importance_gain"),
        F.coalesce("splits", F.lit(0)).cast("long").alias("importance_split"))


def t_learner(df: DataFrame, features, treatment: str, outcome: str, key: str = "user_id", **params):
    """M8: one model on treated rows, one on control rows, grown together."""
    arms = [F.col(treatment) == 0, F.col(treatment) == 1]
    m0, m1 = boosting.fit(df, features, outcome, arms, key, **(TLEARNER_PARAMS | params))
    return m0, m1


def uplift_scores(m0, m1, df: DataFrame) -> DataFrame:
    """M9: uplift = P(churn | control model) − P(churn | treated model)."""
    s0 = score(m0, df, "p_churn_control")
    s1 = score(m1, s0, "p_churn_treated")
    return s1.withColumn("uplift_score", F.col("p_churn_control") - F.col("p_churn_treated"))
