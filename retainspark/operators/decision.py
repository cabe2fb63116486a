"""Segment actions, value, budgeted targeting and reports.

Plan notes
* The action tables are fixed five-row dimensions joined with a broadcast
  hint – their size is bounded by construction.
* Table-wide percentiles (VIP p75 of clv, risk p70 of churn) are scalar
  subqueries over the distributed exact-quantile search.
* The running cost is ``global_running_sum`` over the actionable subset only;
  the full plan is that subset unioned with the rest (no join back).
* The what-if planner evaluates every budget of the grid in one pass: each
  row's smallest admitting budget is arithmetic on its running cost, so rows
  are grouped by budget level instead of being paired with every budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rules import LOST_CAUSE, PERSUADABLE, SLEEPING_DOG, SURE_THING
from ..functions.features import round_half_even
from ..session import stable
from .quantiles import exact_quantile_scalar, exact_quantile_scalars
from .ranking import average_percent_rank, global_running_sum

# Segment → action/priority table.
SEGMENT_ACTIONS = (
    (PERSUADABLE, "Send voucher 20%", "HIGH"),
    (SLEEPING_DOG, "Do NOT contact", "SUPPRESS"),
    (LOST_CAUSE, "Escalate to CS team", "LOW"),
    (SURE_THING, "No action needed", "NONE"),
)
UNKNOWN_ACTION = ("Unknown", "NONE")

# Segment × tier → paid action and cost; VIP above the p75 of clv.
TIERED_ACTIONS = (
    (PERSUADABLE, "VIP", "Voucher 20% + CS Call", 50),
    (PERSUADABLE, "Regular", "Email Voucher 10%", 10),
    (SLEEPING_DOG, "*", "SUPPRESS", 0),
    (LOST_CAUSE, "*", "Escalate CS", 30),
    (SURE_THING, "*", "No Action", 0),
)
DEFAULT_TIERED = ("No Action", 0)
VIP_QUANTILE = 0.75
RISK_QUANTILE = 0.70
DEFAULT_BUDGET = 5000.0
# What-if budget grid (slider 1000..20000 step 500).
BUDGET_MIN, BUDGET_MAX, BUDGET_STEP = 1000, 20000, 500


def segment_action_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SEGMENT_ACTIONS), "segment string, action string, priority string")


def tiered_action_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TIERED_ACTIONS),
                                 "segment string, tier string, action string, cost int")


def segment_actions(df: DataFrame, segment: str = "segment") -> DataFrame:
    """Attach action and priority; unknown segments → Unknown/NONE."""
    dim = F.broadcast(segment_action_table(df.sparkSession)).withColumnRenamed("segment", "__seg")
    out = df.join(dim, F.col(segment) == F.col("__seg"), "left")
    return out.withColumns({
        "recommended_action": F.coalesce("action", F.lit(UNKNOWN_ACTION[0])),
        "priority": F.coalesce("priority", F.lit(UNKNOWN_ACTION[1]))}).drop("__seg", "action")


def segment_by_uplift_percentile(df: DataFrame, uplift: str = "uplift_score",
                                 churn: str = "p_churn_control", high: float = 0.70,
                                 low: float = 0.30, churn_min: float = 0.50) -> DataFrame:
    """R2: percentile segmenter (average-rank percentile of the uplift)."""
    from ..functions.rules import segment_by_percentile
    ranked = average_percent_rank(df, uplift, "uplift_percentile")
    return ranked.withColumn("predicted_segment", segment_by_percentile(
        F.col("uplift_percentile"), F.col(uplift), F.col(churn), high, low, churn_min))


def assign_tiered_actions(scores: DataFrame, vip_quantile: float = VIP_QUANTILE,
                          vip_threshold=None) -> DataFrame:
    """VIP flag against the table-wide clv percentile, then the
    segment × tier action and cost."""
    thr = vip_threshold if vip_threshold is not None else exact_quantile_scalar(
        scores, "clv_proxy", vip_quantile)
    df = scores.withColumns({"clv_threshold": thr})
    df = df.withColumn("is_vip", (F.col("clv_proxy") > F.col("clv_threshold")).cast("int"))
    tier = F.when(F.col("segment") == PERSUADABLE,
                  F.when(F.col("is_vip") == 1, F.lit("VIP")).otherwise(F.lit("Regular"))
                  ).otherwise(F.lit("*"))
    df = df.withColumn("__tier", tier)
    dim = F.broadcast(tiered_action_table(scores.sparkSession)).select(
        F.col("segment").alias("__seg"), F.col("tier").alias("__t"), "action", "cost")
    df = df.join(dim, (F.col("segment") == F.col("__seg")) & (F.col("__tier") == F.col("__t")), "left")
    return df.withColumns({
        "recommended_action": F.coalesce("action", F.lit(DEFAULT_TIERED[0])),
        "action_cost": F.coalesce("cost", F.lit(DEFAULT_TIERED[1])).cast("int"),
    }).drop("__seg", "__t", "__tier", "action", "cost")


def value_and_roi(df: DataFrame) -> DataFrame:
    """Expected clv saved = round(p·clv·max(uplift,0), 2);
    roi = round(value / cost, 2), 0 when the action is free (half-even)."""
    value = round_half_even(F.col("churn_probability") * F.col("clv_proxy")
                            * F.greatest(F.col("uplift_score"), F.lit(0.0)), 2)
    df = df.withColumn("expected_clv_saved", value)
    roi = F.when(F.col("action_cost") > 0, F.col("expected_clv_saved") / F.col("action_cost")
                 ).otherwise(F.lit(0.0))
    return df.withColumn("roi", round_half_even(roi, 2))


def budget_plan(scores: DataFrame, budget: float = DEFAULT_BUDGET,
                risk_quantile: float | None = RISK_QUANTILE, id_col: str = "user_id"):
    """R6 (and R7 with ``risk_quantile=None``, SURVEY D14).

    Returns ``(plan, within_budget)``: every row with its action, value, roi,
    running cost (actionable rows only) and ``targeted`` flag; and the
    targeted rows in roi order.  Ties in roi are broken by ``id_col``.
    """
    # one checkpoint of the score table feeds the quantile search and both
    # branches of the plan (no recomputation of the upstream pipeline)
    scores = stable(scores)
    wanted = {"clv_proxy": VIP_QUANTILE}
    if risk_quantile is not None:
        wanted["churn_probability"] = risk_quantile
    q = exact_quantile_scalars(scores, wanted)
    df = value_and_roi(assign_tiered_actions(scores, vip_threshold=q["clv_proxy"]))
    cond = F.col("segment") == PERSUADABLE
    if risk_quantile is not None:
        cond = cond & (F.col("churn_probability") >= q["churn_probability"])
    df = df.withColumn("__act", cond)
    actionable = df.where(F.col("__act"))
    ranked = global_running_sum(actionable, [F.desc("roi"), F.asc(id_col)],
                                {"cumulative_cost": F.col("action_cost")})
    rest = df.where(~F.col("__act")).withColumn("cumulative_cost", F.lit(None).cast("bigint"))
    plan = ranked.unionByName(rest).withColumn(
        "targeted", F.coalesce((F.col("cumulative_cost") <= F.lit(budget)).cast("int"), F.lit(0))
    ).drop("__act")
    within = plan.where(F.col("targeted") == 1)
    return plan, within


def budget_what_if(scores: DataFrame, budgets=None, id_col: str = "user_id") -> DataFrame:
    """Targeted users, cost, value saved and mean roi for every budget of
    the grid at once, without the risk filter (as the planner page does)."""
    lo, hi, step = budgets or (BUDGET_MIN, BUDGET_MAX, BUDGET_STEP)
    n_levels = (hi - lo) // step + 1
    scores = stable(scores)
    df = value_and_roi(assign_tiered_actions(scores)).where(F.col("segment") == PERSUADABLE)
    ranked = global_running_sum(df, [F.desc("roi"), F.asc(id_col)],
                                {"cumulative_cost": F.col("action_cost")})
    # smallest grid budget b = lo + k·step with cumulative_cost <= b
    k = F.greatest(F.lit(0), F.ceil((F.col("cumulative_cost") - F.lit(lo)) / F.lit(float(step))))
    levels = (ranked.withColumn("level", k.cast("int"))
              .where(F.col("level") < n_levels)
              .groupBy("level")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("action_cost").alias("cost"),
                   F.sum("expected_clv_saved").alias("saved"), F.sum("roi").alias("roi_sum")))
    grid = scores.sparkSession.range(n_levels).select(F.col("id").cast("int").alias("level"))
    w = Window.orderBy("level").rowsBetween(Window.unboundedPreceding, 0)  # ≤ n_levels rows
    g = grid.join(levels, "level", "left").na.fill(0, ["n", "cost"]).na.fill(0.0, ["saved", "roi_sum"])
    g = g.select((F.lit(lo) + F.col("level") * step).cast("int").alias("budget"),
                 F.sum("n").over(w).alias("targeted_users"),
                 F.sum("cost").over(w).alias("total_cost"),
                 F.sum("saved").over(w).alias("expected_clv_saved"),
                 F.sum("roi_sum").over(w).alias("__roi"))
    return g.select("budget", "targeted_users", "total_cost", "expected_clv_saved",
                    F.when(F.col("targeted_users") > 0, F.col("__roi") / F.col("targeted_users"))
                    .alias("avg_roi"))


def campaign_report(plan: DataFrame) -> DataFrame:
    """A13 summary: one row."""
    t = F.col("targeted") == 1
    return plan.agg(
        F.count_if(t).alias("targeted_users"),
        F.coalesce(F.sum(F.when(t, F.col("action_cost"))), F.lit(0)).cast("bigint").alias("total_cost"),
        F.sum(F.when(t, F.col("expected_clv_saved"))).alias("expected_clv_saved"),
        F.avg(F.when(t, F.col("roi"))).alias("avg_roi"),
        F.count_if(F.col("segment") == SLEEPING_DOG).alias("sleeping_dogs_suppressed"),
    )


def action_breakdown(within: DataFrame) -> DataFrame:
    """A13 breakdown: targeted users per action."""
    return within.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("users"))
