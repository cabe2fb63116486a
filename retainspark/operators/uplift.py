"""Uplift evaluation and T-learner scoring.

The uplift curve is a running computation in descending-uplift order:
cumulative treated/control counts and outcomes, whose rate difference is
the curve.  It is one ``global_running_sum`` with four value columns (plus
a position), so it scales like a sort; the AUUC is a trapezoid sum of the
curve divided by n, an ordinary aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import global_running_sum


def uplift_curve(df: DataFrame, uplift: str, treatment: str, outcome: str,
                 id_col: str, order: str = "desc") -> DataFrame:
    """Per row (in uplift order, ties by id): position, cumulative counts
    and ``curve`` = treated outcome rate − control outcome rate so far
    (a rate is 0 while its arm is empty)."""
    t = F.col(treatment).cast("int")
    y = F.col(outcome).cast("double")
    key = F.desc(uplift) if order == "desc" else F.asc(uplift)
    r = global_running_sum(df.select(id_col, uplift, treatment, outcome),
                           [key, F.asc(id_col)],
                           {"position": F.lit(1), "n_t": t, "n_c": 1 - t,
                            "y_t": y * t, "y_c": y * (1 - t)})
    rate_t = F.when(F.col("n_t") > 0, F.col("y_t") / F.col("n_t")).otherwise(0.0)
    rate_c = F.when(F.col("n_c") > 0, F.col("y_c") / F.col("n_c")).otherwise(0.0)
    return r.withColumn("curve", rate_t - rate_c)


def auuc(curve: DataFrame) -> DataFrame:
    """Trapezoid area of the curve over unit steps, divided by n."""
    n = F.max("position")
    first = F.min_by("curve", "position")
    last = F.max_by("curve", "position")
    return curve.agg(((F.sum("curve") - (first + last) / 2.0) / n).alias("auuc"),
                     n.alias("n"))


def random_order_auuc(df: DataFrame, treatment: str, outcome: str, id_col: str,
                      seed: int = 42) -> DataFrame:
    """E12 baseline: the same curve with rows in a deterministic pseudo-random
    order (a seeded hash of the id) instead of the model's uplift."""
    shuffled = df.withColumn("__r", F.xxhash64(F.col(id_col), F.lit(seed)))
    return auuc(uplift_curve(shuffled, "__r", treatment, outcome, id_col))


def t_learner_uplift(df: DataFrame, control_prob: str, treated_prob: str) -> DataFrame:
    """M9: uplift = P(churn | control) − P(churn | treated)."""
    return df.withColumn("uplift_score", F.col(control_prob) - F.col(treated_prob))
