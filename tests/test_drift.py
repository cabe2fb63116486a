"""Drift against plain numpy, with groups, NULLs and empty sides."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retainspark.operators import drift as DR
from retainspark.operators.ranking import running_last

STATS = ("ks_stat", "ks_p_value", "wasserstein_normed", "js_distance", "psi")


def frame(spark, data):
    kinds = ", ".join(f"{c} {'int' if c == 'w' else 'double'}" for c in data.columns)
    return spark.createDataFrame(data.astype(object).where(data.notna(), None), kinds)


@pytest.fixture(scope="module")
def sides():
    rnd = np.random.default_rng(1)
    ref = pd.DataFrame({"a": rnd.normal(1e3, 5, 700).round(1), "b": rnd.integers(0, 4, 700).astype(float), "n": np.nan})
    cur = pd.DataFrame({"a": rnd.normal(1001, 6, 900).round(1), "b": rnd.integers(1, 6, 900).astype(float), "n": np.nan,
                        "w": rnd.integers(0, 3, 900)})
    ref.loc[:50, "a"] = np.nan
    cur.loc[cur.w == 2, "b"] = np.nan
    return ref, cur


def plain(r, c):
    u = np.union1d(r, c)
    fr, fc = (np.searchsorted(x, u, "right") / len(x) for x in (r, c))
    pr, pc = np.diff(fr, prepend=0), np.diff(fc, prepend=0)
    js = sum(0.5 * p * np.log(2 * p / (x + y)) for x, y in zip(pr, pc) for p in (x, y) if p > 1e-12)
    edges = np.clip(np.floor((u - r[0]) / ((r[-1] - r[0]) / 10)), 0, 9).astype(int)
    br, bc = (np.maximum(np.bincount(edges, p, 10), 1e-4) for p in (pr, pc))
    return {"ks_stat": abs(fr - fc).max(), "wasserstein_normed": (abs(fr - fc)[:-1] * np.diff(u)).sum() / r.std(),
            "js_distance": js ** 0.5, "psi": ((bc - br) * np.log(bc / br)).sum(), "n_unique": len(u)}


def test_every_group_against_the_whole_reference(spark, sides):
    ref, cur = sides
    rows = DR.column_drift(frame(spark, ref), frame(spark, cur), ["a", "b", "n"], group="w").collect()
    assert len(rows) == 9
    for r in rows:
        x = np.sort(ref[r.col_name].dropna())
        y = np.sort(cur[cur.w == int(r.group)][r.col_name].dropna())
        assert (r.n_ref, r.n_cur) == (len(x), len(y))
        if len(x) and len(y):
            for name, value in plain(x, y).items():
                assert r[name] == pytest.approx(value, abs=1e-9), (r.group, r.col_name, name)
        else:
            assert all(r[s] is None for s in STATS) and r.drifted is None


def test_empty_sides(spark, sides):
    ref, cur = frame(spark, sides[0]), frame(spark, sides[1])
    for a, b in ((ref, cur.limit(0)), (ref.limit(0), cur), (ref.limit(0), cur.limit(0))):
        rows = DR.column_drift(a, b, ["a", "b"]).collect()
        assert sorted(r.col_name for r in rows) == ["a", "b"] and all(r[s] is None for r in rows for s in STATS)
    assert DR.column_drift(ref, cur.limit(0), ["a"], group="w").count() == 0


def test_constant_columns(spark):
    same = spark.range(50).select(F.lit(3.0).alias("a"))
    row = DR.column_drift(same, same, ["a"]).first()
    assert (row.ks_stat, row.wasserstein_normed, row.js_distance, row.psi, row.drifted) == (0, 0, 0, 0, 0)


def test_running_last_over_slices(spark):
    rnd = np.random.default_rng(3)
    data = pd.DataFrame({"g": rnd.integers(0, 3, 3000) // 2, "t": rnd.permutation(3000), "v": rnd.random(3000)})
    data.loc[rnd.random(3000) < 0.995, "v"] = np.nan  # a known value every 200 rows: most slices rest on a carry
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "g int, t int, v double").repartition(7)
    want = data.sort_values("t").groupby("g").v.ffill()
    got = {(r.g, r.t): r.at for r in running_last(df, ["t"], "v", "at", ["g"]).collect()}
    for (i, row), w in zip(data.iterrows(), want.reindex(data.index)):
        value = got[int(row.g), int(row.t)]
        assert value == w or (value is None and np.isnan(w))
