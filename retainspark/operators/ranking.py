"""Ordering operators.

``global_running_sum`` is the scalable form of an un-partitioned ordered
window (``SUM(x) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING)``), which Spark
would otherwise evaluate in a single task:

1. ``repartitionByRange`` over the whole sort key, ties broken by a row number,
   puts contiguous slices of the order into partitions, and one reliable
   checkpoint fixes which row lies where.  The row number splits a hot key, or a
   constant one, over partitions like any other rows.
2. Rows go to their slice's own task (``repartitionById``) and a window per slice
   (and group) sums inside it.
3. One row of totals per slice gives each slice its starting offset, joined by
   broadcast: as many rows as partitions.  With groups only a group that lies
   in several slices needs a carry; groups are the leading key, so there are
   fewer of them than slices.

The plan has the same size for any number of rows, partitions or groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stable


def _sort_col(c) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def global_running_sum(df: DataFrame, order_by: list, values: dict,
                       partition_by: list | None = None, exclusive: bool = False,
                       partitions: int | None = None) -> DataFrame:
    """Add one running-sum column per entry of ``values`` (name → Column),
    accumulated in ``order_by`` order (column names or sort Columns, e.g.
    ``[F.desc('roi'), F.asc('user_id')]``).  Rows equal in all of them follow
    each other in an order that is fixed within the result.

    With ``partition_by`` (column names) the sums restart for every group;
    groups are the leading sort key, so a hot group is still spread over
    many tasks.  Integral value columns give exact ``bigint`` sums, others
    ``double``.  ``partitions`` sets the number of slices (default: the session's
    shuffle partitions, fewer for small inputs)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups, names = list(partition_by or []), list(values)
    tmp = [f"__v{i}" for i in range(len(names))]
    work = df.withColumns({t: values[nm] for t, nm in zip(tmp, names)} | {"__row_no": F.monotonically_increasing_id()})
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
    kinds = {t: "bigint" if isinstance(work.schema[t].dataType, whole) else "double" for t in tmp}
    work = work.withColumns({t: F.coalesce(F.col(t).cast(k), F.lit(0).cast(k)) for t, k in kinds.items()})
    order = [*[_sort_col(c) for c in order_by], F.col("__row_no").asc()]
    key = [*[_sort_col(g) for g in groups], *order]
    ranged = work.repartitionByRange(partitions, *key) if partitions else work.repartitionByRange(*key)
    ranged = stable(ranged.withColumn("__p", F.spark_partition_id()))

    totals = ranged.groupBy("__p", *groups).agg(*[F.sum(t).alias(t) for t in tmp])
    if groups:
        several = (totals.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
                   .where("__n > 1").select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)]))
        same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)])
        totals = totals.join(F.broadcast(several), same).select("__p", *groups, *tmp)
    before = Window.partitionBy(*groups).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__p").alias("__q"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
                            *[F.sum(t).over(before).alias(f"__o{t}") for t in tmp])
    here = reduce(Column.__and__, [F.col("__p") == F.col("__q"),
                                   *[F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)]])
    w = (Window.partitionBy("__p", *groups).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.repartitionById(n, "__p").withColumns({f"__s{t}": F.sum(t).over(w) for t in tmp})
    out = local.join(F.broadcast(offsets), here, "left")  # at most 2 rows per slice
    zero = {t: F.lit(0).cast(k) for t, k in kinds.items()}
    return out.select(*[c for c in df.columns if c not in names], *[
        (F.col(f"__s{t}") + F.coalesce(F.col(f"__o{t}"), zero[t]) - (F.col(t) if exclusive else zero[t])).alias(nm)
        for t, nm in zip(tmp, names)])


def running_last(df: DataFrame, order_by: list, value: str, out: str, partition_by: list) -> DataFrame:
    """Add ``out``: the last non-null ``value`` at or before the row in the order
    of the columns ``order_by`` within its group – an as-of lookup, if ``df``
    stacks the rows asked for (``value`` null) and those that answer.

    The order is cut into slices as in ``global_running_sum``; a slice takes
    over the last value of the slices before it, one row per slice and group
    that lies in several slices."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = df.withColumn("__row_no", F.monotonically_increasing_id())
    order = [*order_by, "__row_no"]
    ranged = stable(work.repartitionByRange(*partition_by, *order).withColumn("__p", F.spark_partition_id()))
    totals = ranged.groupBy("__p", *partition_by).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("__last"))
    several = totals.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    before = Window.partitionBy(*partition_by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    carried = (totals.join(F.broadcast(several), partition_by)
               .withColumn("__carry", F.last("__last", ignorenulls=True).over(before))
               .select("__p", *partition_by, "__carry"))
    w = (Window.partitionBy("__p", *partition_by).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.repartitionById(n, "__p").withColumn(out, F.last(value, ignorenulls=True).over(w))
    joined = local.join(F.broadcast(carried), ["__p", *partition_by], "left")  # at most 2 rows per slice
    return joined.select(*df.columns, F.coalesce(out, "__carry").alias(out))


def average_percent_rank(df: DataFrame, value: str, out: str = "percentile",
                         partitions: int | None = None) -> DataFrame:
    """Pandas ``rank(pct=True)`` – average rank of ties divided by n.

    Distinct values are counted first (partial aggregate), the running count
    over distinct values gives each value's rank span, and the span table is
    joined back on the value.  NULL values get a NULL rank, are not counted and
    stay out of the join, where they would all meet on one key.
    """
    counts = stable(df.where(F.col(value).isNotNull()).groupBy(value).agg(
        F.count(F.lit(1)).alias("__n")))  # reduced table, reused for the total
    spans = global_running_sum(counts, [F.asc(value)], {"__cum": F.col("__n")}, partitions=partitions)
    total = counts.agg(F.sum("__n")).scalar()
    spans = spans.select(value, ((F.col("__cum") - F.col("__n") + 1 + F.col("__cum")) / F.lit(2.0)
                                 / total).alias(out))
    ranked = df.join(spans, value).select(*df.columns, out)
    return ranked.unionByName(df.where(F.col(value).isNull()).withColumn(out, F.lit(None).cast("double")))


def top_k(df: DataFrame, k: int, order_by: list) -> DataFrame:
    """Sort with a tie-break and keep the first k rows (the limit is
    the report's feature).  Spark plans this as TakeOrderedAndProject: a
    per-partition top-k followed by a k-row merge."""
    return df.orderBy(*order_by).limit(k)


def top_k_per_row(df: DataFrame, columns, k: int, out_top: str = "top", out_bottom: str = "bottom"
                  ) -> DataFrame:
    """The k largest and k smallest values across ``columns`` of each row,
    as arrays of (feature, value) structs."""
    arr = F.array(*[F.struct(F.col(c).cast("double").alias("value"), F.lit(c).alias("feature"))
                    for c in columns])
    srt = F.array_sort(arr)  # ascending by value, then feature
    top = F.reverse(F.slice(srt, -k, k)) if len(columns) >= k else F.reverse(srt)
    bottom = F.slice(srt, 1, k)
    return df.withColumns({out_top: top, out_bottom: bottom})


def arg_extremes(df: DataFrame, id_col: str, score: str, mid: float = 0.5) -> DataFrame:
    """Rows with the highest, lowest and nearest-to-``mid`` score
    (one global aggregate; ties resolved by the smallest id)."""
    s, i = F.col(score), F.col(id_col)
    return df.agg(
        F.min_by(i, F.struct(-s, i)).alias("highest_id"),
        F.min_by(i, F.struct(s, i)).alias("lowest_id"),
        F.min_by(i, F.struct(F.abs(s - F.lit(mid)), i)).alias("nearest_mid_id"),
    )


def latest_per_key(df: DataFrame, keys, order_col: str, tie: str) -> DataFrame:
    """Most recent row per key, of equal times the one with the largest ``tie`` (``max_by`` over a struct keeps it a
    partial aggregate, so a hot key is combined map-side)."""
    cols = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(order_col), F.col(tie))
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("__r"))
    return agg.select(*keys, *[F.col("__r")[c].alias(c) for c in cols])


def nearest_lookup(grid: DataFrame, keys, t_col: str, value_col: str, horizons) -> DataFrame:
    """Value at the grid point closest to each horizon (first grid point
    on ties), per key."""
    out = []
    for h in horizons:
        out.append(F.min_by(F.col(value_col), F.struct(F.abs(F.col(t_col) - F.lit(h)), F.col(t_col)))
                   .alias(f"{value_col}_at_{h}"))
    return grid.groupBy(*keys).agg(*out)
