"""Classifier evaluation as aggregates.

Every curve metric starts by grouping rows by their distinct score
(partial aggregation: a score shared by a third of the rows is one row per
map task), then accumulates positives and negatives over the score order
with ``global_running_sum``.  Nothing is collected; the one-row results are
ordinary DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stable
from .ranking import global_running_sum

F1_EPS = 1e-8


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, pos, neg) per distinct score."""
    y = F.col(label).cast("int")
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve with tied scores counted half
    (Mann–Whitney): Σ_s pos_s·(neg_below_s + neg_s/2) / (P·N)."""
    c = score_counts(df, score, label)
    r = global_running_sum(c, [F.asc("score")], {"neg_below": F.col("neg")}, exclusive=True)
    return r.agg(
        (F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
         / (F.sum("pos") * F.sum("neg"))).alias("auc"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def curve_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """One point per distinct score s (predict positive iff score ≥ s):
    tp, fp, tpr, fpr, precision, recall, f1 (with the ε of the tuning rule)."""
    c = stable(score_counts(df, score, label))  # reduced table, reused for P and N
    r = global_running_sum(c, [F.desc("score")], {"tp": F.col("pos"), "fp": F.col("neg")})
    P = c.select(F.sum("pos")).scalar()
    N = c.select(F.sum("neg")).scalar()
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.col("tp") / P
    out = r.select(F.col("score").alias("threshold"), "tp", "fp",
                   (F.col("tp") / P).alias("tpr"), (F.col("fp") / N).alias("fpr"),
                   prec.alias("precision"), rec.alias("recall"))
    return out.withColumn("f1", 2 * F.col("precision") * F.col("recall")
                          / (F.col("precision") + F.col("recall") + F.lit(F1_EPS)))


def best_f1_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """Threshold maximising F1 over the precision–recall points; ties go
    to the lowest threshold.  One row: threshold, f1, precision, recall."""
    pts = curve_points(df, score, label)
    best = F.max_by(F.struct("threshold", "f1", "precision", "recall"),
                    F.struct(F.col("f1"), -F.col("threshold")))
    return pts.agg(best.alias("b")).select("b.*")


def threshold_metrics(df: DataFrame, score: str, label: str, threshold, inclusive: bool = True
                      ) -> DataFrame:
    """E4 (+A16 counts): precision, recall, F1 and accuracy at a threshold;
    zero division gives 0.  ``threshold`` may be a number or a Column."""
    t = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    s = F.col(score)
    pred = (s >= t) if inclusive else (s > t)
    y = F.col(label) == 1
    k = df.agg(F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
               F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))
    p = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    r = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    k = k.withColumns({"precision": p, "recall": r})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(0.0)
    return k.withColumns({"f1": f1, "accuracy": (F.col("tp") + F.col("tn"))
                          / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))})


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts per (actual, predicted) pair, long form."""
    return df.groupBy(F.col(actual).cast("string").alias("actual"),
                      F.col(predicted).cast("string").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per-class precision, recall, F1, support, then accuracy, macro
    and weighted averages (zero division → 0), as in the usual text report.
    Rows: one per class + 'accuracy', 'macro avg', 'weighted avg'."""
    cm = confusion_matrix(df, actual, predicted)
    sup = cm.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("support"))
    pred = cm.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("predicted_n"))
    hit = cm.where(F.col("actual") == F.col("predicted")).select(F.col("actual").alias("label"),
                                                                  F.col("n").alias("tp"))
    labels = sup.select("label").unionByName(pred.select("label")).distinct()
    per = (labels.join(sup, "label", "left").join(pred, "label", "left").join(hit, "label", "left")
           .na.fill(0, ["support", "predicted_n", "tp"]))
    p = F.when(F.col("predicted_n") > 0, F.col("tp") / F.col("predicted_n")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumns({"precision": p, "recall": r})
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    classes = per.select("label", "precision", "recall", "f1", F.col("support").cast("bigint"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                     F.col("n").cast("bigint").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"),
                       F.col("n").cast("bigint").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"), (F.col("wp") / F.col("n")).alias("precision"),
                          (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                          F.col("n").cast("bigint").alias("support"))
    return classes.unionByName(acc).unionByName(macro).unionByName(weighted)
