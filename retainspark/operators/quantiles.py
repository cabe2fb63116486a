"""Exact quantiles with linear interpolation.

Spark's ``percentile`` aggregate keeps a value→count map for its one global
group in a single task, which does not survive a high-cardinality column at
scale.  ``exact_quantiles`` finds the same answer with distributed work only:

1. A mergeable sketch (``percentile_approx``) brackets every quantile by two values
   whose ranks lie a few thousandths of a per cent of the rows apart.
2. A second scan counts the values below each bracket and shuffles only those
   inside it, reduced to a count per value.  The counts prove whether the ranks
   that are asked for lie inside; a bracket that misses is widened and asked
   again, in the end to the whole column.
3. For quantile q of a column with N non-NULL values, position h=(N−1)·q: the values
   at ranks floor(h) and ceil(h) come from a running count over the brackets'
   values, and lo + (hi − lo)·(h − floor(h)) is the answer.

So what is shuffled follows the sketch's accuracy and not the number of distinct values.
NULLs and NaNs are skipped, as pandas and SQL ``quantile_cont`` skip NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stable
from .ranking import global_running_sum

#: Rank error of the sketch is at most one row in this many.
ACCURACY = 20_000
#: Half widths of a bracket, in rank errors; the last one takes the whole column.
WIDTHS = (2, 200, None)


def _probability(q: float, width: int) -> tuple[float, float]:
    slack = width / ACCURACY
    return max(0.0, q - slack), min(1.0, q + slack)


def _brackets(df: DataFrame, columns: list, asked: list[tuple[int, float]], width: int | None) -> list[tuple]:
    """(column, quantile, low, high, values of the column) per pair asked; the sketch's
    answers are one row of as many cells."""
    cells = []
    for i in sorted({i for i, _ in asked}):
        v = F.when(~F.isnan(F.col(columns[i]).cast("double")), F.col(columns[i]).cast("double"))
        probs = [p for j, q in asked if j == i for p in _probability(q, width or 0)]
        cells += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"z{i}"),
                  F.percentile_approx(v, probs, ACCURACY).alias(f"p{i}")]
    row = df.agg(*cells).first()
    out, seen = [], {}
    for i, q in asked:
        k = seen[i] = seen.get(i, -1) + 1
        if not row[f"n{i}"]:
            continue
        lo, hi = row[f"p{i}"][2 * k:2 * k + 2]
        edge = _probability(q, width or 0)
        # a sketch's end need not be the column's
        lo = row[f"a{i}"] if width is None or edge[0] == 0.0 else lo
        hi = row[f"z{i}"] if width is None or edge[1] == 1.0 else hi
        out.append((i, q, lo, hi, row[f"n{i}"]))
    return out


def _inside(df: DataFrame, columns: list, brackets: list[tuple]) -> DataFrame:
    """``(b, v, n)``: how often which value is in bracket b; a null v stands for all values
    below it, which map-side combine makes one row a task."""
    value = [F.col(columns[i]).cast("double") for i, *_ in brackets]
    hit = F.array(*[F.when((v <= hi) & ~F.isnan(v), F.struct(F.lit(k).alias("b"), F.when(v >= lo, v).alias("v")))
                    for k, (v, (_, _, lo, hi, _)) in enumerate(zip(value, brackets, strict=True))])
    rows = df.select(F.explode(F.filter(hit, lambda x: x.isNotNull())).alias("s")).select("s.b", "s.v")
    return rows.groupBy("b", "v").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, columns, qs) -> DataFrame:
    """Long result: (column_name, q, value) for every column × quantile; a column without
    a value has no row.  The driver handles a few numbers per column and quantile."""
    columns, spark = list(columns), df.sparkSession
    asked = [(i, float(q)) for i in range(len(columns)) for q in sorted({float(q) for q in qs})]
    done: list[tuple] = []
    for width in WIDTHS:
        brackets = _brackets(df, columns, asked, width) if asked else []
        if not brackets:
            break
        counts = stable(_inside(df, columns, brackets))
        # a row per bracket
        sums = {r["b"]: r for r in counts.groupBy("b").agg(F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("below"),
                                                           F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("held")).collect()}
        inside = counts.where("v IS NOT NULL")
        found, asked = [], []
        for k, (i, q, _, _, n) in enumerate(brackets):
            h = (n - 1) * q
            lo, hi = int(h), -int(-h // 1)
            below, held = (sums[k]["below"], sums[k]["held"]) if k in sums else (0, 0)
            if below <= lo and hi < below + held:
                found.append((k, i, q, h - lo, lo - below, hi - below))
            else:
                asked.append((i, q))
        if found:
            done += _at_ranks(inside, found)
    names = [(columns[i], q, v) for i, q, v in sorted(done)]
    return spark.createDataFrame(names, "column_name string, q double, value double")


def _at_ranks(inside: DataFrame, found: list[tuple]) -> list[tuple]:
    """(column, quantile, value) for ranks (from 0) inside the brackets."""
    want = inside.sparkSession.createDataFrame([(k, lo, hi) for k, _, _, _, lo, hi in found], "b int, lo long, hi long")
    ranked = global_running_sum(inside, [F.asc("v")], {"cum": F.col("n")}, partition_by=["b"])
    holds = lambda r: (F.col(r) >= F.col("cum") - F.col("n")) & (F.col(r) < F.col("cum"))
    rows = (ranked.join(F.broadcast(want), "b")  # a row per bracket
            .groupBy("b").agg(F.max(F.when(holds("lo"), F.col("v"))).alias("v_lo"), F.max(F.when(holds("hi"), F.col("v"))).alias("v_hi")).collect())
    at = {r["b"]: r for r in rows}
    return [(i, q, at[k]["v_lo"] + (at[k]["v_hi"] - at[k]["v_lo"]) * part) for k, i, q, part, _, _ in found]


def exact_quantile_scalar(df: DataFrame, column: str, q: float) -> Column:
    """One quantile as a scalar-subquery Column usable in any expression."""
    return exact_quantiles(df.select(column), [column], [q]).select("value").scalar()


def exact_quantile_scalars(df: DataFrame, wanted: dict) -> dict:
    """Several (column → q) quantiles from one search, as scalar subqueries."""
    cols = list(wanted)
    qs = sorted(set(float(q) for q in wanted.values()))
    tab = exact_quantiles(df.select(*cols), cols, qs)
    return {c: tab.where((F.col("column_name") == c) & (F.col("q") == float(q))).select("value").scalar()
            for c, q in wanted.items()}
