"""Profiling and reporting aggregates.

All of them are single- or two-pass aggregates planned by Catalyst with
partial (map-side) aggregation; results are long-form tables so that the
number of profiled columns never turns into a wide single row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stable
from .quantiles import exact_quantiles

# aggregates wider than this many buffer fields leave whole-stage codegen
CODEGEN_MAX_FIELDS = 100  # Spark's default spark.sql.codegen.maxFields

#: Nodes per bandwidth of a binned density.
KDE_NODES = 128
#: Up to so many groups their statistics (a row each) are broadcast.
KDE_BROADCAST_GROUPS = 10_000


def _cols(df: DataFrame, cols):
    return list(cols) if cols is not None else df.columns


def describe(df: DataFrame, cols) -> DataFrame:
    """A1: count, mean, sample std, min, exact quartiles (linear
    interpolation), max per column – long form (one row per column).

    Counts, extremes and means are plain aggregates, the spread Σ (v − mean)² a
    second one around the means, the quartiles ``exact_quantiles``: nothing is
    grouped by value but the few thousandths of the rows around a quartile."""
    cols, spark = list(cols), df.sparkSession
    value = lambda c: F.col(c).cast("double")

    def per_column(make) -> DataFrame:
        """Named cells per column, in codegen-sized aggregates, as (ci, names)."""
        per, parts = max(1, CODEGEN_MAX_FIELDS // 8), []
        for lo in range(0, len(cols), per):
            chunk = list(enumerate(cols))[lo:lo + per]
            one = df.agg(*[v.alias(f"{name}_{i}") for i, c in chunk for name, v in make(i, value(c)).items()])
            parts.append(one.select(F.explode(F.array(*[
                F.struct(F.lit(i).alias("ci"), *[F.col(f"{name}_{i}").alias(name) for name in make(i, value(c))]) for i, c in chunk]))
                .alias("t")).select("t.*"))
        return reduce(DataFrame.unionByName, parts)

    basic = stable(per_column(lambda i, v: {"count": F.count(v), "mean": F.avg(v), "min": F.min(v), "max": F.max(v)}))
    mean = {r["ci"]: r["mean"] for r in basic.select("ci", "mean").collect()}  # a row per described column
    out = basic.join(per_column(lambda i, v: {"__ss": F.sum(F.pow(v - F.lit(mean[i]).cast("double"), 2))}), "ci")
    q = (exact_quantiles(df, cols, [0.25, 0.5, 0.75])
         .groupBy("column_name").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value")))
    q = q.select("column_name", F.col("`0.25`").alias("q25"), F.col("`0.5`").alias("q50"),
                 F.col("`0.75`").alias("q75"))
    names = spark.createDataFrame(list(enumerate(cols)), "ci int, column_name string")
    out = names.join(out, "ci").join(q, "column_name", "left")
    return out.select("column_name", "count", "mean", F.when(F.col("count") > 1, F.sqrt(F.col("__ss") / (F.col("count") - 1))).alias("std"),
                      "min", "q25", "q50", "q75", "max")


def missing_profile(df: DataFrame, cols=None) -> DataFrame:
    """A2: NULL count and percentage per column, only columns with NULLs
    (one codegen-sized aggregate per chunk of columns)."""
    cols = _cols(df, cols)
    per = CODEGEN_MAX_FIELDS - 2
    parts = []
    for lo in range(0, len(cols), per):
        chunk = list(enumerate(cols))[lo:lo + per]
        one = df.agg(F.count(F.lit(1)).alias("__n"),
                     *[F.count_if(F.col(c).isNull()).alias(f"__m{i}") for i, c in chunk])
        parts.append(one.select("__n", F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"__m{i}").alias("missing"))
            for i, c in chunk])).alias("s")))
    long = parts[0]
    for p_ in parts[1:]:
        long = long.unionByName(p_)
    return long.select("s.column_name", "s.missing",
                       (F.col("s.missing") * 100.0 / F.col("__n")).alias("missing_pct")
                       ).where(F.col("missing") > 0)


def duplicate_count(df: DataFrame, cols=None) -> DataFrame:
    """A3: number of rows equal to an earlier row, in one scan.

    Rows are equal if 192 bits of their cells agree: a 64-bit hash and an MD5
    digest over every cell's length and value, by which a cell's end and NULL are
    told from content.  Only these keys are grouped and shuffled, never a text."""
    cols = _cols(df, cols)
    kinds = dict(df.dtypes)

    def cell(c: str) -> Column:
        v = F.col(f"`{c}`")
        if kinds[c] in ("double", "float"):
            v = v + F.lit(0.0)  # -0.0 equals 0.0
        if kinds[c].startswith(("array", "struct")):
            v = F.to_json(v, {"ignoreNullFields": "false"})
        v = v.cast("binary") if kinds[c] == "binary" else v.cast("string").cast("binary")
        head = F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":")), F.lit("-")).cast("binary")
        return F.concat(head, F.coalesce(v, F.lit(b"")))

    key = df.select(F.xxhash64(*[F.col(f"`{c}`") for c in cols]).alias("h"), F.md5(F.concat(*[cell(c) for c in cols])).alias("d"))
    return key.groupBy("h", "d").agg(F.count(F.lit(1)).alias("k")).agg(
        F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A4: count and share per value (NULL is its own value)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("n") / total)


def rate_by_category(df: DataFrame, label: str, cols, scale: float = 100.0) -> DataFrame:
    """A5: ``scale``×mean(label) per value of each column, all columns in one
    pass (GROUPING SETS → one Expand + one partial aggregate)."""
    cols = list(cols)
    base = df.select(F.col(label).cast("double").alias("__y"),
                     *[F.col(c).cast("string").alias(c) for c in cols])
    g = base.groupingSets([[c] for c in cols], *cols).agg(
        (F.avg("__y") * scale).alias("rate"), F.count(F.lit(1)).alias("n"),
        F.grouping_id().alias("__gid"))
    full = (1 << len(cols)) - 1
    col_name = None
    val = None
    for i, c in enumerate(cols):
        gid = full ^ (1 << (len(cols) - 1 - i))
        col_name = (F.when(F.col("__gid") == gid, F.lit(c)) if col_name is None
                    else col_name.when(F.col("__gid") == gid, F.lit(c)))
        val = (F.when(F.col("__gid") == gid, F.col(c)) if val is None
               else val.when(F.col("__gid") == gid, F.col(c)))
    return g.select(col_name.alias("column_name"), val.alias("value"), "rate", "n")


def group_means(df: DataFrame, by: str, cols) -> DataFrame:
    """Mean of each column per group."""
    return df.groupBy(by).agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])


def _moments(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Counts, means of the first column, its squared deviations and the
    co-deviations of every pair of columns, over rows where both are known."""
    m = known.astype(np.float64)
    n = m.T @ m
    shift = np.where(known, x, 0.0).sum(0) / np.maximum(m.sum(0), 1)  # keeps the products small
    z = np.where(known, x - shift, 0.0)
    mean = (z.T @ m) / np.maximum(n, 1)
    return np.stack([n, mean + shift[:, None], (z * z).T @ m - n * mean ** 2, z.T @ z - n * mean * mean.T])


def _merge_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows from those of each."""
    n = a[0] + b[0]
    part = b[0] / np.maximum(n, 1)
    d = np.where(b[0] > 0, np.where(a[0] > 0, b[1] - a[1], 0.0), 0.0)
    mean = np.where(a[0] > 0, a[1] + d * part, b[1])
    return np.stack([n, mean, a[2] + b[2] + d * d * a[0] * part, a[3] + b[3] + d * d.T * a[0] * part])


def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson correlation for every column pair, long form
    (col_a, col_b, corr) with col_a before col_b in ``cols``, over the rows in
    which neither is NULL; NULL if there are none or one of the two is constant.

    One scan and one path: each task reduces its Arrow batches to pairwise counts,
    means and co-deviations, which merge exactly as sets of rows do; tasks' rows (a
    few numbers per pair) merge in a tree of two levels.  A NaN makes its column's
    correlations NaN."""
    cols = list(cols)
    p = len(cols)
    schema = "m array<double>"

    def out(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["m"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)
                known = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in b.columns], axis=1)
                one = _moments(x, known)
                total = one if total is None else _merge_moments(total, one)
        yield from out(total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for cells in b.column(0):
                one = cells.values.to_numpy().reshape(4, p, p)
                total = one if total is None else _merge_moments(total, one)
        yield from out(total)

    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(rows, schema)
    level = max(1, int(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
    one = parts.repartition(level).mapInArrow(merge, schema).repartition(1).mapInArrow(merge, schema)
    at = lambda kind, i, j: F.coalesce(F.element_at("m", kind * p * p + i * p + j + 1), F.lit(0.0))
    pair = lambda i, j: F.struct(
        F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"), at(2, i, j).alias("a"), at(2, j, i).alias("b"), at(3, i, j).alias("ab"))
    return (one.groupBy().agg(F.first("m").alias("m"))  # a row even for an empty table
            .select(F.explode(F.array(*[pair(i, j) for i, j in combinations(range(p), 2)])).alias("t"))
            .select("t.col_a", "t.col_b", F.when((F.col("t.a") > 0) & (F.col("t.b") > 0),
                                                 F.col("t.ab") / F.sqrt(F.col("t.a") * F.col("t.b"))).alias("corr")))


def target_correlation(df: DataFrame, target: str, cols) -> DataFrame:
    """Correlation of each column with the target, ranked descending
    (rank 1 = strongest positive); the top/bottom five are rank filters."""
    cols = list(cols)
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("corr"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    w = Window.orderBy(F.desc_nulls_last("corr"), "feature")  # one row per column: bounded
    return long.withColumn("rank", F.row_number().over(w).cast("bigint"))


def pivot_effect(df: DataFrame, group: str, arm: str, outcome: str) -> DataFrame:
    """Mean outcome by group × arm; effect = control − treated."""
    p = df.groupBy(group).pivot(arm, [0, 1]).agg(F.avg(F.col(outcome).cast("double")))
    return p.select(group, F.col("0").alias("control_rate"), F.col("1").alias("treated_rate"),
                    (F.col("0") - F.col("1")).alias("uplift"))


def portfolio_kpis(scores: DataFrame, high_risk: float = 0.7) -> DataFrame:
    """A10: totals, high-risk and persuadable counts and shares, mean risk."""
    p = F.col("churn_probability")
    k = scores.agg(F.count(F.lit(1)).alias("total"),
                   F.count_if(p > high_risk).alias("high_risk"),
                   F.count_if(F.col("segment") == "Persuadable").alias("persuadable"),
                   F.avg(p).alias("avg_churn_probability"))
    return k.select("total", "high_risk", (F.col("high_risk") * 100.0 / F.col("total")).alias("high_risk_pct"),
                    "persuadable", (F.col("persuadable") * 100.0 / F.col("total")).alias("persuadable_pct"),
                    "avg_churn_probability")


def histogram(df: DataFrame, col: str, bins: int = 50, by: str | None = None,
              density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max] of the whole column; the last
    bin is closed on the right.  With ``by`` the bins are shared and counted
    per group; ``density`` divides by (group count × bin width)."""
    x = F.col(col).cast("double")
    b = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()  # one row, one pass
    lo, hi = F.lit(b["lo"]).cast("double"), F.lit(b["hi"]).cast("double")
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.lit(bins - 1), F.floor((x - lo) * (F.lit(float(bins)) / (hi - lo)))).cast("int")
    idx = F.when(hi == lo, F.lit(0)).otherwise(idx)
    keys = ([by] if by else [])
    counted = df.where(x.isNotNull()).select(*keys, idx.alias("bin")).groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"))
    out = counted.select(*keys, "bin", (lo + F.col("bin") * width).alias("lower"),
                         (lo + (F.col("bin") + 1) * width).alias("upper"), "n")
    if density:
        if keys:
            tot = df.where(x.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("__t"))
            out = out.join(tot, keys)
        else:
            out = out.withColumn("__t", df.where(x.isNotNull()).select(F.count(F.lit(1))).scalar())
        out = out.withColumn("density", F.col("n") / (F.col("__t") * width)).drop("__t")
    return out


def table_audit(tables: dict) -> DataFrame:
    """Per table its row count and latest timestamp, unioned.
    ``tables`` maps a name to (DataFrame, timestamp column)."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                    F.max(F.col(ts)).alias("latest"))
             for name, (df, ts) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Negatives / positives (the boosted-tree positive weight)."""
    y = F.col(label)
    return df.agg(F.count_if(y == 0).alias("negatives"), F.count_if(y == 1).alias("positives")
                  ).withColumn("ratio", F.col("negatives") / F.col("positives"))


def score_audit(scores: DataFrame, segments=("Persuadable", "Sleeping_Dog", "Lost_Cause", "Sure_Thing")
                ) -> DataFrame:
    """Score file audit: rows, segment counts, mean probability, clv sum, and
    the latest ``scored_at`` if the scores have that column."""
    last = [F.max("scored_at").alias("last_scored_at")] if "scored_at" in scores.columns else []
    return scores.agg(F.count(F.lit(1)).alias("rows"),
                      *[F.count_if(F.col("segment") == s).alias(f"n_{s.lower()}") for s in segments],
                      F.avg("churn_probability").alias("avg_churn_probability"),
                      F.sum("clv_proxy").alias("total_clv"), *last)


def plan_audit(plan: DataFrame, targeted: DataFrame) -> DataFrame:
    """Users in the action plan, users targeted within the budget, and what these
    cost and are expected to save."""
    cost = targeted.agg(F.count(F.lit(1)).alias("targeted_users"), F.coalesce(F.sum("action_cost"), F.lit(0)).cast("bigint").alias("total_cost"),
                        F.coalesce(F.sum("expected_clv_saved"), F.lit(0.0)).alias("total_clv_saved"))
    return cost.withColumn("plan_users", plan.select(F.count(F.lit(1))).scalar())


def kde(df: DataFrame, col: str, by: str, grid_points: int = 200, own_grid: bool = False) -> DataFrame:
    """Gaussian kernel density per group at ``grid_points`` places, Scott's
    bandwidth h (sample std × n^(−1/5)), from min − range/2 to max + range/2 of the
    whole column, or of each group with ``own_grid``.

    Rows are binned to nodes h / ``KDE_NODES`` apart, where a group leaves four
    sums per occupied node: the powers 0 to 3 of the distances to the node.  The
    kernel is expanded around the node by them, so a density is off by less than
    0.0032 / (h · ``KDE_NODES``⁴) from the sum over all rows (1.2e-11 / h).  What
    is shuffled follows the occupied nodes, never the rows or distinct values.

    NULL values and groups take no part; a group of one row or one value has no
    bandwidth and no rows."""
    x = F.col(f"`{col}`").cast("double")
    rows = df.where(x.isNotNull() & F.col(f"`{by}`").isNotNull()).select(F.col(f"`{by}`").alias(by), x.alias("v"))
    stats = rows.groupBy(by).agg(F.count("v").alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    if not own_grid:
        stats = stats.withColumns({"lo": F.min("lo").over(Window.partitionBy()), "hi": F.max("hi").over(Window.partitionBy())})
    stats = stable(stats.where("sd > 0").withColumn("bw", F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))))
    if stats.count() <= KDE_BROADCAST_GROUPS:
        stats = F.broadcast(stats)
    gap = F.col("bw") / KDE_NODES
    binned = rows.join(stats, by).withColumn("node", F.floor((F.col("v") - F.col("lo")) / gap + 0.5))
    off = (F.col("v") - F.col("lo") - F.col("node") * gap) / F.col("bw")
    nodes = binned.groupBy(by, "node").agg(F.count(F.lit(1)).alias("m0"), *[F.sum(F.pow(off, F.lit(k))).alias(f"m{k}") for k in (1, 2, 3)])
    step = (F.col("hi") - F.col("lo")) * 2 / F.lit(float(grid_points - 1))
    at = F.col("lo") - (F.col("hi") - F.col("lo")) / 2 + F.col("g") * step
    terms = nodes.join(stats, by).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1)))).withColumn("t", at)
    z = (F.col("t") - F.col("lo") - F.col("node") * gap) / F.col("bw")
    # the kernel's derivatives are Hermite polynomials times the kernel
    series = (F.col("m0") + F.col("m1") * z + F.col("m2") / 2 * (z * z - 1) + F.col("m3") / 6 * z * (z * z - 3))
    return terms.groupBy(by, "g", "t").agg(F.sum(
        series * F.exp(-0.5 * z * z) / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))
