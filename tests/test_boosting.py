"""Boosted trees by distributed histograms, and what is built on them."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from retainspark.operators import attribution as AT
from retainspark.operators import boosting as B
from retainspark.operators import metrics as M
from retainspark.operators import models as ML

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1200, 3)).round(2)
    y = (rng.random(1200) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] * (x[:, 2] > 0))))).astype(int)
    cells = [(i, *(float(v) for v in r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    cells[5] = (5, None, float("nan"), 0.1, 1)
    return spark.createDataFrame(cells, "id long, a double, b double, c double, y int").repartition(3).persist()


def by_hand(x, y, p):
    """One round after another on the whole table, leaf-wise, without bins ahead."""
    base = math.log(y.mean() / (1 - y.mean()))
    margin = np.full(len(y), base)
    for _ in range(p["rounds"]):
        chance = 1 / (1 + np.exp(-margin))
        g, h = chance - y, chance * (1 - chance)
        leaves = [(np.arange(len(y)), 0)]

        def split(rows):
            best = (1e-9, None, None)
            for f in range(x.shape[1]):
                for t in np.unique(x[rows, f])[:-1]:
                    left = x[rows, f] <= t
                    a, b = rows[left], rows[~left]
                    if min(len(a), len(b)) < p["min_rows"]:
                        continue
                    gain = g[a].sum() ** 2 / h[a].sum() + g[b].sum() ** 2 / h[b].sum() - g[rows].sum() ** 2 / h[rows].sum()
                    if gain > best[0] + 1e-9:
                        best = (gain, a, b)
            return best

        open_ = [(split(leaves[0][0]), *leaves[0])]
        done = []
        while open_ and len(open_) + len(done) < p["leaves"]:
            open_.sort(key=lambda s: -s[0][0])
            (_, a, b), r, depth = open_.pop(0)
            if a is None:
                done.append(r)
                continue
            for part in (a, b):
                if depth + 1 < p["max_depth"]:
                    open_.append((split(part), part, depth + 1))
                else:
                    done.append(part)
        for r in [*done, *(s[1] for s in open_)]:
            margin[r] -= p["rate"] * g[r].sum() / h[r].sum()
    return margin


def test_equals_growth_on_the_whole_table(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(3 - 0.5 * x[:, 0] + 0.1 * x[:, 1] * (x[:, 2] > 5)))).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))],
                               "id long, a double, b double, c double, y int").repartition(4)
    p = dict(rounds=4, leaves=6, rate=0.3, min_rows=15, max_depth=4)
    model = B.fit(df, COLS, "y", [F.lit(True)], "id", feature_fraction=1.0, bagging_fraction=1.1, **p)[0]
    assert np.allclose(model.margins(x), by_hand(x, y, p), atol=1e-9)
    got = {r.id: r.p for r in ML.score(model, df, "p").collect()}
    assert np.allclose([got[i] for i in range(400)], 1 / (1 + np.exp(-model.margins(x))))


def test_models_grown_together_are_those_grown_alone(spark, rows):
    p = dict(rounds=3, leaves=8)
    arms = [F.col("id") % 3 != i for i in range(3)]
    together = B.fit(rows, COLS, "y", arms, "id", **p)
    x = np.array([[r.a if r.a is not None else np.nan, r.b, r.c] for r in rows.orderBy("id").collect()], dtype=float)
    for m, arm in zip(together, arms, strict=True):
        alone = B.fit(rows, COLS, "y", [arm], "id", **p)[0]
        assert np.allclose(m.margins(x), alone.margins(x))


def test_early_stop_keeps_the_best_prefix(spark, rows):
    held = F.col("id") % 4 == 0
    model = B.fit(rows, COLS, "y", [~held], "id", valid=[held], patience=4, rounds=60, rate=0.5)[0]
    v = rows.where(held).toPandas()
    x, y = v[COLS].to_numpy(dtype=float), v["y"].to_numpy()
    full = B.fit(rows, COLS, "y", [~held], "id", rounds=len(model.trees) + 4, rate=0.5)[0]
    losses = []
    for k in range(len(full.trees) + 1):
        z = B.BoostedTrees(COLS, full.base, full.trees[:k]).margins(x)
        losses.append(float((np.logaddexp(0, z) - y * z).mean()))
    assert len(model.trees) == int(np.argmin(losses)) < 60


def test_auc_is_near_the_librarys_boosting(spark, rows):
    train, test = rows.where("id % 4 != 0"), rows.where("id % 4 = 0")
    ours = B.fit(train, COLS, "y", [F.lit(True)], "id", rounds=40, leaves=31, max_depth=5)[0]
    theirs = ML.train_gbt(train.na.fill(0.0), COLS, "y", {"maxIter": 40}, weight=None)
    a = M.roc_auc(ML.score(ours, test), "churn_probability", "y").first()["auc"]
    b = M.roc_auc(ML.score(theirs, test.na.fill(0.0)), "churn_probability", "y").first()["auc"]
    assert a > b - 0.01


def jobs_of(spark, group, run):
    """The result of ``run`` and the tasks of each of its jobs."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    seen = spark.sparkContext.statusTracker()
    stages = [[seen.getStageInfo(i) for i in seen.getJobInfo(j).stageIds] for j in seen.getJobIdsForGroup(group)]
    return out, [sum(s.numTasks for s in job if s and s.numCompletedTasks) for job in stages]


def test_a_job_has_no_more_tasks_than_cores(spark):
    # before, 8,192 rows were a task of their own and its sums went through further stages
    df = spark.range(200_000).select("id", *[(F.rand(i) * 20).alias(c) for i, c in enumerate(COLS)], (F.rand(9) < 0.3).cast("int").alias("y"))
    model, tasks = jobs_of(spark, "rounds", lambda: B.fit(df, COLS, "y", [F.lit(True)], "id", rounds=3)[0])
    rounds = tasks[-10:]  # the jobs of the last round
    assert len(model.trees) == 3 and max(rounds) <= spark.sparkContext.defaultParallelism
    assert sum(t.rows[0] for t in model.trees) == pytest.approx(3 * 0.8 * 200_000, rel=0.01)


def test_blocks_are_written_anew_once_in_some_rounds(spark, rows, monkeypatch):
    # before, every round sent all blocks through a further Python process and back
    written, advance = [], B._advance
    monkeypatch.setattr(B, "_advance", lambda *a: written.append(len(a[-1])) or advance(*a))
    held = F.col("id") % 4 == 0
    run = lambda: B.fit(rows, COLS, "y", [~held], "id", valid=[held], patience=50, rounds=12)[0]
    few = run()
    assert written == [B.ADVANCE] * 2
    monkeypatch.setattr(B, "ADVANCE", 1)
    x = np.random.default_rng(1).normal(size=(200, 3))
    assert len(written) == 2 and np.array_equal(few.margins(x), run().margins(x))


def test_partitions_follow_cores_and_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [B._partitions(spark, n) for n in (0, 1, B.LEAST_ROWS + 1, cores * B.MOST_ROWS)] == [1, 1, min(2, cores), cores]
    assert B._partitions(spark, 3 * cores * B.MOST_ROWS) == 3 * cores


def test_sums_of_more_partitions_than_the_driver_takes_at_once(spark):
    parts = spark.sparkContext.parallelize(range(B.FAN_IN + 5), B.FAN_IN + 5).map(lambda i: np.array([1.0, i]).tobytes())
    assert B._summed(parts).tolist() == [B.FAN_IN + 5, sum(range(B.FAN_IN + 5))]


def test_save_and_load(spark, rows, tmp_path):
    model = B.fit(rows, COLS, "y", [F.lit(True)], "id", rounds=2)[0]
    model.save(spark, str(tmp_path / "m"))
    again = B.BoostedTrees.load(spark, str(tmp_path / "m"), COLS)
    x = np.random.default_rng(0).normal(size=(50, 3))
    assert np.array_equal(model.margins(x), again.margins(x)) and len(again.trees) == 2
    shares = {r.feature: (r.importance_gain, r.importance_split) for r in ML.feature_importance(again).collect()}
    assert set(shares) == set(COLS) and sum(g for g, _ in shares.values()) == pytest.approx(1.0)
    assert sum(n for _, n in shares.values()) == sum(f >= 0 for t in model.trees for f in t.feature)


def test_tables_without_an_effect(spark):
    schema = "id long, a double, b double, c double, y int"
    for cells in ([], [(1, 1.0, 2.0, None, None)], [(i, 1.0, None, float(i), 1) for i in range(30)]):
        model = B.fit(spark.createDataFrame(cells, schema), COLS, "y", [F.lit(True), F.col("id") < 0], "id", rounds=2)[0]
        assert np.isfinite(model.margins(np.zeros((3, 3)))).all()


def test_cross_validation_over_held_out_folds(spark, rows):
    df = rows.withColumn("id", F.concat(F.lit("C"), F.col("id")))
    r = ML.cross_validate(df, COLS, "y", k=3, id_col="id", rounds=15).first()
    assert r.folds == 3 and 0.7 < r.cv_mean_auc < 0.95 and 0 < r.cv_std_auc < 0.1


def brute_shapley(x, leaves, n):
    """Shapley values of one row over all subsets of the features."""
    def worth(subset):
        total = 0.0
        for value, path in leaves:
            for f, t, left, share in path:
                value *= ((x[f] <= t) == left) if f in subset else share
            total += value
        return total
    out = np.zeros(n)
    for j in range(n):
        rest = [f for f in range(n) if f != j]
        for k in range(n):
            for s in itertools.combinations(rest, k):
                out[j] += math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n) * (worth({*s, j}) - worth(s))
    return out, worth(())


def deep_tree(rng, n, depth):
    def grow(path, level):
        if level == depth or (level > 2 and rng.random() < 0.2):
            return [(float(rng.normal()), path)]
        f, t, share = int(rng.integers(n)), float(rng.normal()), float(rng.uniform(0.1, 0.9))
        return grow([*path, (f, t, True, share)], level + 1) + grow([*path, (f, t, False, 1 - share)], level + 1)
    return grow([], 0)


def test_tree_attributions_equal_shapley_values():
    rng = np.random.default_rng(11)
    for n, depth in ((4, 5), (6, 4), (2, 6), (7, 7)):
        trees = [(1.0, deep_tree(rng, n, depth)) for _ in range(2)]
        x = rng.normal(size=(5, n))
        phi, base = AT.tree_shap_batch(x, trees, n, 1.0)
        for i in range(5):
            parts = [brute_shapley(x[i], leaves, n) for _, leaves in trees]
            assert np.allclose(phi[i], sum(p for p, _ in parts), atol=1e-9)
            assert base == pytest.approx(sum(b for _, b in parts))


def test_attributions_cost_a_pattern_not_a_row():
    # 2,000 rows of 2^k patterns: equal to few rows at a time, which are not looked up
    rng = np.random.default_rng(5)
    trees = [(1.0, deep_tree(rng, 5, 5)) for _ in range(3)]
    x = rng.normal(size=(2000, 5))
    phi, base = AT.tree_shap_batch(x, trees, 5, 1.0)
    few = np.concatenate([AT.tree_shap_batch(x[i:i + 2], trees, 5, 1.0)[0] for i in range(0, 2000, 2)])
    assert phi.shape == (2000, 5) and np.array_equal(phi, few)


def test_tree_attributions_of_a_depth_12_ensemble_add_up(spark):
    rng = np.random.default_rng(2)
    n = 14
    trees = [(0.5, deep_tree(rng, n, 12)) for _ in range(2)]
    x = rng.normal(size=(20, n))
    phi, base = AT.tree_shap_batch(x, trees, n, 1.0)
    value = [sum(0.5 * v * all((r[f] <= t) == left for f, t, left, _ in path) for _, leaves in trees for v, path in leaves) for r in x]
    assert np.allclose(phi.sum(axis=1) + base, value, atol=1e-9)


def test_attributions_of_the_boosted_model_add_up(spark, rows):
    model = B.fit(rows, COLS, "y", [F.lit(True)], "id", rounds=5)[0]
    out = AT.tree_attributions(rows, model, COLS, "id").toPandas().set_index("id").sort_index()
    x = rows.orderBy("id").toPandas()[COLS].to_numpy(dtype=float)
    assert np.allclose(out.to_numpy()[:, :3].sum(axis=1) + out["base_value"], model.margins(x), atol=1e-9)


@pytest.mark.parametrize("drifted", [0, 1])
def test_retrain_follows_the_drift_flag(spark, rows, tmp_path, drifted):
    from retainspark.operators import registry as RG
    from retainspark.sources import io as IO
    df = rows.select(F.concat(F.lit("C"), F.col("id")).alias("customerID"), *COLS, "y").persist()
    flag, fp, models = (str(tmp_path / n) for n in ("flag", "fp", "models"))
    reg = RG.Registry(spark, str(tmp_path / "registry"))
    run = lambda: RG.gated_retrain(df, reg, flag, fp, models, COLS, "y", params={"rounds": 4})
    IO.record_fingerprint(df, fp)
    assert run() is None  # no flag was ever written
    IO.write_summary(spark.createDataFrame([(drifted,)], "drift_detected int"), flag)
    auc = run()
    assert (auc is not None) == bool(drifted) and reg.versions().count() == drifted
    if drifted:
        assert 0.6 < auc < 1.0 and run() is None  # the flag was cleared
        saved = B.BoostedTrees.load(spark, f"{models}/churn_v1", COLS)
        assert 1 <= len(saved.trees) <= 4
        config = IO.read_summary(spark, f"{models}/model_config", "churn_threshold double, auc_roc double").first()
        assert config.auc_roc == pytest.approx(auc, abs=1e-6) and 0 < config.churn_threshold < 1
