"""Densities, correlations and duplicates against plain versions."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retainspark.operators import profile as P


@pytest.mark.parametrize("own", [False, True])
def test_density_is_the_sum_over_all_rows(spark, own):
    rnd = np.random.default_rng(5)
    data = pd.DataFrame({"y": rnd.integers(0, 2, 3000), "v": np.append(rnd.normal(50, 9, 2990), rnd.uniform(0, 4000, 10))})
    df = spark.createDataFrame(data).unionAll(spark.createDataFrame([(1, None), (None, 3.0), (7, 5.0)], "y long, v double"))
    got = P.kde(df, "v", "y", 150, own_grid=own).toPandas()
    assert sorted(got.y.unique()) == [0, 1]  # one row has no bandwidth
    for y, rows in got.groupby("y"):
        v = data[data.y == y].v.to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        side = v if own else np.append(data.v.to_numpy(), 5.0)
        grid = np.linspace(side.min() - np.ptp(side) / 2, side.max() + np.ptp(side) / 2, 150)
        want = np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
        rows = rows.sort_values("g")
        assert np.allclose(rows.t, grid, atol=1e-9)
        assert abs(rows.density.to_numpy() - want).max() < 1.2e-11 / h + 1e-13


def test_density_of_an_empty_table(spark):
    assert P.kde(spark.createDataFrame([], "y int, v double"), "v", "y").count() == 0


def test_correlation_merges_far_means_and_nulls(spark):
    rnd = np.random.default_rng(2)
    a = rnd.normal(1e6, 1, 4000)
    data = pd.DataFrame({"a": a, "b": a + rnd.normal(0, 1, 4000), "c": rnd.normal(size=4000), "d": 4.0, "e": np.nan})
    data.loc[:2999, "c"] = np.nan  # whole tasks without a value
    data.loc[rnd.random(4000) < 0.3, "b"] = np.nan
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "a double, b double, c double, d double, e double")
    got = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df.repartition(9), list("abcde")).collect()}
    want = data.corr()
    assert len(got) == 10
    for (x, y), v in got.items():
        if {x, y} & {"d", "e"}:
            assert v is None
        else:
            assert v == pytest.approx(want.loc[x, y], abs=1e-9)
    assert all(r.corr is None for r in P.correlation_matrix(df.limit(0), ["a", "b"]).collect())


def test_duplicates_tell_null_empty_and_borders_apart(spark):
    rows = [("a", "b"), ("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), (None, "ab"), ("-", "1:x"), (None, "x")]
    df = spark.createDataFrame(rows, "x string, `y.z` string")
    assert P.duplicate_count(df).first()[0] == 2
    zero = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "v double")
    assert P.duplicate_count(zero).first()[0] == 1
    assert P.duplicate_count(df.limit(0)).first()[0] == 0
    nested = spark.range(4).select(F.array(F.col("id") % 2, F.lit(None)).alias("l"))
    assert P.duplicate_count(nested).first()[0] == 2
