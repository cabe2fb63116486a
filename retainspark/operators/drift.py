"""Data drift between a reference and a current table (D1o–D4o, S11).

All columns are tested together: both tables are stacked into (column, value)
and reduced to counts per distinct value (partial aggregation).  The reference's
ranks at every value are one running sum over the value order
(``global_running_sum`` with the column as the restart key, so a column or value
holding a third of all rows is still split over tasks), each group's ranks
another, and the reference's quantiles at a group's ranks are an as-of lookup in
the rank order (``running_last``, whose slices hand on their last value).

The test of a column is a parameter, never a consequence of the row count:
``stattest`` for all columns but those named ``categorical``.  All statistics
are reported whatever the test.
* ``ks``: two-sample Kolmogorov–Smirnov with the asymptotic p-value (drift if
  p < 0.05);
* ``wasserstein`` (default): Wasserstein-1 distance normed by the reference
  standard deviation (drift if ≥ 0.1);
* ``jensenshannon`` (categorical columns): Jensen–Shannon distance (natural log)
  of the value shares (drift if ≥ 0.1).
PSI over 10 equal-width reference bins is reported as well.
Dataset drift: share of drifted columns ≥ threshold (0.3, inclusive).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stable
from .ranking import global_running_sum, running_last

# Drift thresholds.
DRIFT_SHARE_THRESHOLD = 0.3
KS_ALPHA = 0.05
WASSERSTEIN_THRESHOLD = 0.1
JS_THRESHOLD = 0.1
PSI_THRESHOLD = 0.1
PSI_BINS = 10
PSI_EPS = 0.0001

# The monitored feature columns.
DRIFT_COLUMNS = ("tenure", "MonthlyCharges", "TotalCharges", "recency_risk", "service_count",
                 "charge_per_month", "clv_proxy", "contract_stability", "digital_engagement",
                 "SeniorCitizen", "Contract_encoded", "InternetService_encoded")
CATEGORICAL_COLUMNS = ("SeniorCitizen", "Contract_encoded", "InternetService_encoded")


def common_columns(ref: DataFrame, cur: DataFrame, wanted=DRIFT_COLUMNS) -> list:
    """Wanted columns present in both tables, in the wanted order."""
    return [c for c in wanted if c in ref.columns and c in cur.columns]


def _stack(df: DataFrame, cols, group: str | None):
    g = F.col(group).cast("string") if group else F.lit("all")
    return df.select(g.alias("grp"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("s")).select("grp", "s.col_name", "s.v")


def ks_p_value(d, en):
    """Asymptotic Kolmogorov tail Q(λ) with Stephens' correction
    λ = (√n_e + 0.12 + 0.11/√n_e)·D.  Two series, each used where it
    converges fast: λ < 1.18: Q = 1 − (√(2π)/λ) Σ_{k≥1} e^{−(2k−1)²π²/(8λ²)};
    otherwise Q = 2 Σ_{k≥1} (−1)^{k−1} e^{−2k²λ²}.  Q(0) = 1."""
    lam = (F.sqrt(en) + 0.12 + 0.11 / F.sqrt(en)) * d
    ks = F.sequence(F.lit(1), F.lit(100))
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * F.aggregate(
        ks, F.lit(0.0), lambda acc, k: acc + F.exp(-F.pow(2.0 * k - 1, 2) * F.lit(math.pi ** 2)
                                                   / (8.0 * lam * lam)))
    large = 2.0 * F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1)
                              * F.exp(-2.0 * k * k * lam * lam))
    q = F.when(lam <= 0, F.lit(1.0)).when(lam < 1.18, small).otherwise(large)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), q))


def _reference(values: DataFrame, spark, cols) -> tuple:
    """One row per column: rows ``N_r``, distinct values ``U_r``, mean, population
    deviation and the counts ``r0``… of the PSI bins of the reference; and the
    bin of a row that carries them."""
    per = values.where((F.col("nr") > 0) & F.col("v").isNotNull())
    first = per.groupBy("col_name").agg(
        F.sum("nr").alias("N_r"), F.count(F.lit(1)).alias("U_r"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        (F.sum(F.col("nr") * F.col("v")) / F.sum("nr")).alias("mean"))
    width = (F.col("hi") - F.col("lo")) / PSI_BINS
    psi_bin = F.when(width > 0, F.least(F.lit(PSI_BINS - 1), F.greatest(F.lit(0), F.floor(
        (F.col("v") - F.col("lo")) / width)))).otherwise(F.lit(0)).cast("int")
    second = (per.join(F.broadcast(first.select("col_name", "lo", "hi", "mean")), "col_name").groupBy("col_name").agg(
        F.sqrt(F.sum(F.col("nr") * F.pow(F.col("v") - F.col("mean"), 2)) / F.sum("nr")).alias("ref_std"),
        *[F.sum(F.when(psi_bin == k, F.col("nr")).otherwise(0)).alias(f"r{k}") for k in range(PSI_BINS)]))
    names = spark.createDataFrame([(c,) for c in cols], "col_name string")  # a column without values has its row too
    out = names.join(first, "col_name", "left").join(second, "col_name", "left")
    return stable(out.na.fill({"N_r": 0, "U_r": 0})), psi_bin


def column_drift(ref: DataFrame, cur: DataFrame, cols=None, group: str | None = None,
                 stattest: str = "wasserstein", categorical=CATEGORICAL_COLUMNS) -> DataFrame:
    """D1o: one row per (group, column) with n_ref, n_cur, distinct values,
    KS statistic and p-value, normed Wasserstein, JS distance, PSI, the test
    that decides and the drift flag.

    With ``group`` the current table is split by that column (D4o weekly
    tracking) and every group is compared with the whole reference.  The
    reference is ranked once for all groups and never repeated per group: work and
    shuffles follow the distinct values of the reference plus those of each group.

    NULLs take no part.  A column without values on either side has its row,
    with NULL statistics; an empty current table has no group."""
    if stattest not in ("ks", "wasserstein", "jensenshannon"):
        raise ValueError(f"unknown test: {stattest}")
    cols, spark = list(cols or common_columns(ref, cur)), ref.sparkSession
    # both sides as counts per distinct value, one row per (column, value): the
    # reference's count and a cell per group that has the value
    known = F.col("v").isNotNull()
    r = (_stack(ref, cols, None).where(known).groupBy("col_name", "v").agg(F.count(F.lit(1)).alias("nr"))
         .withColumn("cell", F.lit(None).cast("struct<grp: string, nc: bigint>")))
    c = (_stack(cur, cols, group).groupBy("grp", "col_name", "v").agg(F.count("v").alias("nc"))
         .select("col_name", "v", F.lit(0).cast("bigint").alias("nr"), F.struct("grp", "nc").alias("cell")))
    values = stable(r.unionByName(c).groupBy("col_name", "v").agg(F.sum("nr").alias("nr"),
                                                                  F.collect_list("cell").alias("cells")))
    per_col, psi_bin = _reference(values, spark, cols)
    per_grp = (values.select("col_name", F.explode("cells").alias("cell")).groupBy(F.col("cell.grp").alias("grp"), "col_name")
               .agg(F.sum("cell.nc").alias("N_c")))
    if not group:  # an empty current table still has its row
        per_grp = (spark.createDataFrame([("all", x) for x in cols], "grp string, col_name string")
                   .join(per_grp, ["grp", "col_name"], "left").na.fill({"N_c": 0}))

    # ranks of the reference at every value: n rows up to it, and the sum of their
    # distances from the mean
    ranked = values.where(known).join(F.broadcast(per_col), "col_name")
    ranked = stable(global_running_sum(
        ranked.select("col_name", "v", "nr", "cells", (F.col("v") - F.col("mean")).alias("x"), "N_r", psi_bin.alias("bin")),
        [F.asc("v")], {"s0": F.col("nr"), "s1": F.col("nr") * F.col("x")}, partition_by=["col_name"]))
    cells = (ranked.select("col_name", "v", "x", "nr", "s0", "s1", "N_r", "bin", F.explode("cells").alias("cell"))
             .select("*", F.col("cell.grp").alias("grp"), F.col("cell.nc").alias("nc")).drop("cell"))
    cells = global_running_sum(cells, [F.asc("v")], {"cc": F.col("nc")}, partition_by=["grp", "col_name"])
    cells = cells.join(per_grp, ["grp", "col_name"])
    # Wasserstein in rank space: a value's rows take the ranks lo..hi, scaled to the
    # reference's count; there the reference's quantiles lie below the value up to
    # rank s0 and above it from there on, so the integral of |quantile − value|
    # follows from the quantiles' running integral at lo, hi and s0 (which is s1)
    scale = lambda n: n * F.col("N_r") / F.col("N_c")
    cells = cells.withColumns({"lo": scale(F.col("cc") - F.col("nc")), "hi": scale(F.col("cc"))})
    x, lo, hi, s0 = F.col("x"), F.col("lo"), F.col("hi"), F.col("s0")
    cells = stable(cells.withColumn(
        "own", F.when(s0 < lo, x * (lo - hi)).when(s0 > hi, x * (hi - lo)).otherwise(x * (2 * s0 - lo - hi) - 2 * F.col("s1"))))
    border = F.explode(F.array(
        F.struct(lo.alias("rank"), F.when(s0 >= lo, 1).otherwise(-1).alias("sign")),
        F.struct(hi.alias("rank"), F.when(s0 <= hi, 1).otherwise(-1).alias("sign"))))
    asked = (cells.where("N_r > 0").select("grp", "col_name", border.alias("b"))
             .select("col_name", F.col("b.rank").alias("rank"), F.lit(1).alias("side"), "grp", F.col("b.sign").alias("sign"),
                     F.lit(None).cast("struct<start: double, below: double, x: double>").alias("step")))
    start = (F.col("s0") - F.col("nr")).cast("double")
    steps = ranked.where("nr > 0").select(
        "col_name", start.alias("rank"), F.lit(0).alias("side"), F.lit(None).cast("string").alias("grp"), F.lit(None).cast("int").alias("sign"),
        F.struct(start.alias("start"), (F.col("s1") - F.col("nr") * F.col("x")).alias("below"), F.col("x").alias("x")).alias("step"))
    found = running_last(steps.unionByName(asked), ["rank", "side"], "step", "at", ["col_name"]).where("side = 1")
    borders = found.groupBy("grp", "col_name").agg(F.sum(F.col("sign") * (
        F.col("at.below") + (F.col("rank") - F.col("at.start")) * F.col("at.x"))).alias("borders"))

    # values of the reference alone need no row per group: between two of a group's
    # values its share stands still, and the reference's is extreme at the ends
    gap = lambda n, m: F.abs(F.try_divide(n, F.col("N_r")) - m / F.col("N_c"))
    pr, pc = F.try_divide("nr", "N_r"), F.col("nc") / F.col("N_c")
    kl = lambda p: F.when(p > 0, p * F.log(2 * p / (pr + pc))).otherwise(F.lit(0.0))
    per_cell = cells.where("N_r > 0").groupBy("grp", "col_name").agg(
        F.max(F.greatest(gap(s0, F.col("cc")), gap(s0 - F.col("nr"), F.col("cc") - F.col("nc")))).alias("ks_stat"),
        F.sum("own").alias("own"), F.sum(0.5 * kl(pr) + 0.5 * kl(pc)).alias("js"), F.sum("nr").alias("shared"),
        *[F.sum(F.when(F.col("bin") == k, F.col("nc")).otherwise(0)).alias(f"c{k}") for k in range(PSI_BINS)])
    new = cells.groupBy("grp", "col_name").agg(F.count_if(F.col("nr") == 0).alias("new"))
    # one row per (group, column) from here on
    out = (per_grp.join(F.broadcast(per_col), "col_name").join(per_cell, ["grp", "col_name"], "left")
           .join(borders, ["grp", "col_name"], "left").join(new, ["grp", "col_name"], "left"))
    share = lambda n, total: F.greatest(F.try_divide(n, F.col(total)), F.lit(PSI_EPS))
    psi = sum(((share(F.col(f"c{k}"), "N_c") - share(F.col(f"r{k}"), "N_r"))
               * F.log(share(F.col(f"c{k}"), "N_c") / share(F.col(f"r{k}"), "N_r")) for k in range(PSI_BINS)), F.lit(0.0))
    out = out.withColumns({
        "n_unique": F.col("U_r") + F.coalesce("new", F.lit(0)),
        "wasserstein": F.when(F.col("borders").isNotNull(), F.try_divide(
            F.greatest(F.lit(0.0), F.col("own") + F.col("borders")), F.col("N_r"))),
        "js_divergence": F.col("js") + F.lit(0.5 * math.log(2.0)) * F.try_divide(F.col("N_r") - F.col("shared"), F.col("N_r")),
        "psi": F.when((F.col("N_r") > 0) & (F.col("N_c") > 0), psi)})
    en = F.when((F.col("N_r") > 0) & (F.col("N_c") > 0), F.col("N_r") * F.try_divide(F.col("N_c"), F.col("N_r") + F.col("N_c")))
    out = out.withColumns({
        "ks_p_value": F.when(en.isNotNull(), ks_p_value(F.col("ks_stat"), en)),
        "wasserstein_normed": F.when(F.col("ref_std") > 0, F.try_divide("wasserstein", "ref_std"))
                               .otherwise(F.col("wasserstein")),
        "js_distance": F.when(en.isNotNull(), F.sqrt(F.greatest(F.col("js_divergence"), F.lit(0.0)))),
    })
    out = out.withColumn("stattest", F.when(F.col("col_name").isin(*categorical), F.lit("jensenshannon"))
                         .otherwise(F.lit(stattest)))
    drifted = (F.when(F.col("stattest") == "ks", F.col("ks_p_value") < KS_ALPHA)
               .when(F.col("stattest") == "wasserstein", F.col("wasserstein_normed") >= WASSERSTEIN_THRESHOLD)
               .otherwise(F.col("js_distance") >= JS_THRESHOLD))
    return out.withColumn("drifted", drifted.cast("int")).select(
        F.col("grp").alias("group"), "col_name", F.col("N_r").alias("n_ref"), F.col("N_c").alias("n_cur"),
        "n_unique", "ks_stat", "ks_p_value", "wasserstein_normed", "js_distance", "psi", "stattest",
        "drifted")


def dataset_drift(col_drift: DataFrame, threshold: float = DRIFT_SHARE_THRESHOLD) -> DataFrame:
    """D2o: per group, drifted / total columns and the inclusive threshold."""
    return col_drift.groupBy("group").agg(
        F.sum("drifted").cast("bigint").alias("n_drifted_columns"),
        F.count(F.lit(1)).alias("n_total_columns")).withColumns({
            "drift_score": F.col("n_drifted_columns") / F.col("n_total_columns"),
            "threshold": F.lit(float(threshold))}).withColumn(
        "drift_detected", (F.col("drift_score") >= F.col("threshold")).cast("int"))


def drift_summary(ds: DataFrame, at=None) -> DataFrame:
    """D3o: the one-record summary (timestamp as %Y%m%d_%H%M%S text)."""
    ts = at if at is not None else F.current_timestamp()
    return ds.select(F.date_format(ts, "yyyyMMdd_HHmmss").alias("timestamp"), "drift_score",
                     "n_drifted_columns", "n_total_columns", "drift_detected", "threshold")
