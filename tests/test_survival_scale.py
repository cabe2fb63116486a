"""Survival operators on durations that are nearly all distinct."""

import numpy as np
import pytest

from retainspark.operators import survival as SV


def all_pairs(t, e, s):
    before = (t[:, None] < t[None, :]) | ((t[:, None] == t[None, :]) & (e[None, :] == 0))
    np.fill_diagonal(before, False)
    before &= e[:, None] == 1
    return int((before & (s[None, :] > s[:, None])).sum()), int((before & (s[None, :] == s[:, None])).sum()), int(before.sum())


@pytest.mark.parametrize("durations,scores,deaths", [(10 ** 9, 10 ** 9, 0.5), (7, 10 ** 9, 0.5), (10 ** 9, 5, 0.9), (30, 9, 0.3), (1, 1, 1.0)])
def test_concordance_equals_all_pairs(spark, durations, scores, deaths):
    rng = np.random.default_rng(durations % 97 + scores % 89)
    n = 1500
    t, s = rng.integers(0, durations, n).astype(float), rng.integers(0, scores, n) / 8.0
    e = (rng.random(n) < deaths).astype(int)
    top = s > np.quantile(s, 0.9)
    e[top] = 0  # all censored on top
    df = spark.createDataFrame([(*map(float, r[:2]), int(r[2])) for r in zip(t, s, e, strict=True)] + [(None, 1.0, 1), (1.0, None, 1)],
                               "t double, s double, e int").repartition(5)
    r = SV.concordance_index(df, "t", "e", "s").first()
    correct, tied, pairs = all_pairs(t, e, s)
    assert (r.correct, r.tied, r.pairs) == (correct, tied, pairs)
    assert r.c_index == pytest.approx((correct + tied / 2) / pairs) if pairs else r.c_index is None


def test_concordance_of_many_distinct_durations(spark):
    n = 100_000
    df = spark.range(n).selectExpr("cast(id * 7919 % 100003 as double) t", "cast(id * 104729 % 100019 as double) s", "cast(id % 3 > 0 as int) e")
    i = np.arange(n, dtype=np.int64)
    t, s, e = i * 7919 % 100003, i * 104729 % 100019, (i % 3 > 0).astype(int)
    r = SV.concordance_index(df, "t", "e", "s").first()
    # by descending duration: a sorted list of the scores that left later
    order = np.argsort(-t, kind="stable")
    assert len(np.unique(t)) == len(np.unique(s)) == n
    tree = np.zeros(1 << 17, dtype=np.int64)
    rank = np.argsort(np.argsort(s)) + 1
    correct = pairs = 0
    for seen, j in enumerate(order.tolist()):
        if e[j]:
            k, low = int(rank[j]), 0
            while k:
                low += int(tree[k])
                k &= k - 1
            correct, pairs = correct + seen - low, pairs + seen
        k = int(rank[j])
        while k < len(tree):
            tree[k] += 1
            k += k & -k
    assert (r.correct, r.tied, r.pairs) == (correct, 0, pairs)


def test_concordance_without_pairs(spark):
    for rows in ([], [(1.0, 1.0, 0)], [(1.0, 1.0, 1)]):
        r = SV.concordance_index(spark.createDataFrame(rows, "t double, s double, e int"), "t", "e", "s").first()
        assert (r.correct, r.tied, r.pairs, r.c_index) == (0, 0, 0, None)


def plain_cox(beta, x, t, e):
    """Log-likelihood and gradient, all durations different."""
    order = np.argsort(-t)
    x, e = x[order], e[order].astype(bool)
    w = np.exp(x @ beta)
    s0, s1 = np.cumsum(w), np.cumsum(w[:, None] * x, axis=0)
    return float((x @ beta - np.log(s0))[e].sum()), (x - s1 / s0[:, None])[e].sum(axis=0)


@pytest.mark.parametrize("ties", ["efron", "breslow"])
def test_cox_fit_of_many_distinct_durations(spark, ties):
    n = 100_000
    df = spark.range(n).selectExpr("cast(id * 7919 % 100003 as double) t", "cast(id * 104729 % 1009 / 300 as double) a",
                                   "cast(id * 31 % 7 + id * 7919 % 100003 / 40000 as double) b", "cast(id % 3 > 0 as int) e")
    rows = df.toPandas()
    x, t, e = rows[["a", "b"]].to_numpy(), rows["t"].to_numpy(), rows["e"].to_numpy()
    assert len(np.unique(t)) == n
    fit = SV.cox_fit(df, "t", "e", ["a", "b"], penalizer=0.0, ties=ties)
    ll, grad = plain_cox(np.array(fit["coef"]), x - x.mean(axis=0), t, e)
    assert fit["log_likelihood"] == pytest.approx(ll, rel=1e-10)
    assert np.abs(grad / n).max() < 1e-6
    se = [r.se for r in fit["summary"].collect()]
    eps = 1e-4
    info = -np.array([(plain_cox(np.array(fit["coef"]) + eps * d, x, t, e)[1] - plain_cox(np.array(fit["coef"]) - eps * d, x, t, e)[1]) / (2 * eps)
                      for d in np.eye(2)])
    assert se == pytest.approx(np.sqrt(np.diag(np.linalg.inv(info))), rel=1e-5)


def test_cox_fit_leaves_null_rows_out_and_takes_a_hot_duration(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=900)
    t = np.where(np.arange(900) % 3 == 0, 5.0, np.ceil(rng.exponential(np.exp(-0.8 * x)) * 20))  # a third leaves at one time
    rows = [(float(a), float(b), int(c)) for a, b, c in zip(t, x, rng.random(900) < 0.7, strict=True)]
    plain = SV.cox_fit(spark.createDataFrame(rows, "t double, x double, e int"), "t", "e", ["x"])
    nulls = [(None, 1.0, 1), (3.0, None, 1), (3.0, float("nan"), 1), (3.0, 1.0, None)]
    other = SV.cox_fit(spark.createDataFrame(rows + nulls, "t double, x double, e int").repartition(7), "t", "e", ["x"])
    assert other["coef"] == pytest.approx(plain["coef"], abs=1e-9) and plain["converged"]


def plain_remaining(ts, hs, ph, t0):
    """Trapezoids over the whole timeline and from ``t0`` on, the latter over S(t0)."""
    s = np.exp(-hs * ph)
    k = np.searchsorted(ts, t0, side="right") - 1
    if k < 0:
        return np.trapezoid(s, ts), np.trapezoid(s, ts)
    rest = np.exp(-(hs[k:] - hs[k]) * ph)
    steps = np.diff(ts[k:])
    tail = float((steps * (rest[1:] + rest[:-1]) / 2).sum())
    return np.trapezoid(s, ts), tail - ((t0 - ts[k]) * (1 + rest[1]) / 2 if len(rest) > 1 else 0.0)


def test_expected_remaining_of_a_million_distinct_durations(spark):
    n = 1_000_000
    zdf = spark.range(n).selectExpr("cast(id * 7919 % 1000003 as double) + 50 t", "cast(id % 3 > 0 as int) e", "cast(id % 101 / 50 - 1 as double) z0")
    fit = {"zdf": zdf, "beta_std": np.array([0.4]), "covariates": ["x"], "coef": np.array([0.4]), "mean": np.array([0.0])}
    asked = [(i, x, t) for i, (x, t) in enumerate((x, t) for x in (-9.0, -1.3, 0.0, 0.05, 2.2, 11.0)
                                                  for t in (0.0, 49.9, 50.0, 50.5, 1234.25, 500_000.0, 900_000.7, 1_000_052.0, 2e6))]
    got = {r.id: r for r in SV.expected_remaining(spark.createDataFrame(asked, "id int, x double, tenure double"), fit).collect()}
    i = np.arange(n, dtype=np.int64)
    ts, z, e = (i * 7919 % 1000003).astype(float) + 50, i % 101 / 50 - 1, i % 3 > 0
    order = np.argsort(ts)
    ts, w, e = ts[order], np.exp(0.4 * z)[order], e[order]
    hs = np.cumsum(np.where(e, 1 / np.cumsum(w[::-1])[::-1], 0.0))
    for k, x, t in asked:
        life, rest = plain_remaining(ts, hs, np.exp(0.4 * x), t)
        assert got[k].expected_lifetime == pytest.approx(life, rel=1e-9)
        if t < ts[-1]:
            assert got[k].expected_residual == pytest.approx(rest, rel=1e-7, abs=1e-6), (x, t)
        else:
            assert got[k].expected_residual <= 1e-6


def test_expected_remaining_nulls_and_repeats(spark):
    zdf = spark.createDataFrame([(1.0, 1, 0.0), (2.0, 1, 0.0), (4.0, 0, 0.0)], "t double, e int, z0 double")
    fit = {"zdf": zdf, "beta_std": np.array([0.0]), "covariates": ["x"], "coef": np.array([0.0]), "mean": np.array([0.0])}
    rows = [(1, 0.0, 1.0), (1, 0.0, 1.0), (2, None, 1.0), (3, 0.0, None), (4, 0.0, 9.0), (5, 0.0, 0.5)]
    df = spark.createDataFrame(rows, "k int, x double, tenure double")
    got = sorted(((r.k, r.expected_lifetime, r.expected_tenure_remaining, r.expected_residual) for r in SV.expected_remaining(df, fit).collect()), key=str)
    ts, hs = np.array([1.0, 2.0, 4.0]), np.array([1 / 3, 1 / 3 + 1 / 2, 1 / 3 + 1 / 2])
    life, rest = plain_remaining(ts, hs, 1.0, 1.0)
    assert [g[0] for g in got] == [1, 1, 2, 3, 4, 5]
    assert got[0] == got[1] and got[0][1:] == pytest.approx((life, round(life - 1, 1), rest))
    assert got[2][1:] == (None, 0.0, 0.0)
    assert got[3][1:] == pytest.approx((life, 0.0, 0.0))
    assert got[4][1:] == pytest.approx((life, 0.0, 0.0))
    assert got[5][1:] == pytest.approx((life, round((life - 0.5) * 10) / 10, life))
    assert SV.expected_remaining(df.where("false"), fit).collect() == []
