"""Feature attributions.

For a linear-logistic model the exact additive attribution of feature f on
the log-odds scale is w_f·(x_f − mean_f), with the base value
intercept + Σ w_f·mean_f – the same quantity a path-independent explainer
returns for linear models.  Everything is a column expression over the
scored table plus one aggregate for the means (a scalar subquery).
Tree ensembles: exact path-dependent Shapley values, leaf by leaf (see
``tree_shap_batch``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import LinearScorer
from .boosting import BoostedTrees
from .ranking import top_k_per_row


def linear_attributions(df: DataFrame, scorer: LinearScorer, id_col: str) -> DataFrame:
    """Per row, one contribution column per feature (``shap_<f>``) and
    the base value.  Long form is ``attributions_long``."""
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c, _ in scorer.coefficients])
    cols = {}
    base = F.lit(float(scorer.intercept))
    centers = dict(scorer.centers)
    for c, w in scorer.coefficients:
        m = means.select(c).scalar()
        cols[f"shap_{c}"] = F.lit(float(w)) * (F.col(c).cast("double") - m)
        base = base + F.lit(float(w)) * (m - F.lit(float(centers.get(c, 0.0))))
    return df.select(id_col, *[v.alias(k) for k, v in cols.items()], base.alias("base_value"))


def attributions_long(attr: DataFrame, id_col: str) -> DataFrame:
    feats = [c for c in attr.columns if c.startswith("shap_")]
    return attr.unpivot([id_col], feats, "feature", "contribution").withColumn(
        "feature", F.expr("substring(feature, 6)"))


def global_importance(attr: DataFrame, id_col: str) -> DataFrame:
    """Mean absolute contribution per feature (sort for the report)."""
    return attributions_long(attr, id_col).groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_shap"))


def top_drivers(attr: DataFrame, id_col: str, k: int = 5) -> DataFrame:
    """E15 (W7): the k largest (drivers) and k smallest (protectors)
    contributions of every row, long form (id, kind, rank, feature, value)."""
    feats = [c for c in attr.columns if c.startswith("shap_")]
    t = top_k_per_row(attr.select(id_col, *[F.col(c).alias(c[5:]) for c in feats]),
                      [c[5:] for c in feats], k)
    drivers = t.select(id_col, F.lit("driver").alias("kind"),
                       F.posexplode("top").alias("pos", "x"))
    protectors = t.select(id_col, F.lit("protector").alias("kind"),
                          F.posexplode("bottom").alias("pos", "x"))
    return drivers.unionByName(protectors).select(
        id_col, "kind", (F.col("pos") + 1).alias("rank"), F.col("x.feature").alias("feature"),
        F.col("x.value").alias("value"))


def dependence(df: DataFrame, attr: DataFrame, id_col: str, features) -> DataFrame:
    """(feature value, contribution) pairs for the chosen features."""
    long = attributions_long(attr, id_col).where(F.col("feature").isin(list(features)))
    vals = df.select(id_col, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("feature_value"))
        for f in features])).alias("s")).select(id_col, "s.*")
    return long.join(vals, [id_col, "feature"])


# ------------------------------------------------------------------ tree ensembles


def tree_arrays(model):
    """(base, scale, trees) of a boosted ensemble.  A tree is its weight and its
    leaves: (value, path), the path a (feature, threshold, goes left, share of the
    parent's training rows) per node.  Model metadata: trees × leaves entries."""
    if isinstance(model, BoostedTrees):
        return model.base, 1.0, [(1.0, _leaves(t)) for t in model.trees]
    trees = []
    weights = list(model.treeWeights)
    for ti, jt in enumerate(model._java_obj.trees()):
        leaves = []
        stack = [(jt.rootNode(), [])]
        while stack:
            node, path = stack.pop()
            if node.getClass().getSimpleName() == "InternalNode":
                f, thr = node.split().featureIndex(), node.split().threshold()
                cnt = node.impurityStats().count()
                left, right = node.leftChild(), node.rightChild()
                lc, rc = left.impurityStats().count(), right.impurityStats().count()
                stack.append((left, path + [(f, thr, True, lc / cnt if cnt else 0.5)]))
                stack.append((right, path + [(f, thr, False, rc / cnt if cnt else 0.5)]))
            else:
                leaves.append((node.prediction(), path))
        trees.append((weights[ti], leaves))
    return 0.0, 2.0, trees  # the margin of the boosted log-loss is half the log-odds


def _leaves(t):
    """Leaves of a ``boosting.Tree`` with their paths."""
    out, stack = [], [(0, [])]
    while stack:
        n, path = stack.pop()
        if t.feature[n] < 0:
            out.append((t.value[n], path))
            continue
        for child, left in ((t.left[n], True), (t.right[n], False)):
            stack.append((child, [*path, (t.feature[n], t.threshold[n], left, t.rows[child] / t.rows[n])]))
    return out


def tree_shap_batch(X, trees, n_features: int, scale: float = 2.0):
    """Exact path-dependent tree SHAP for a batch (rows × features array).

    A leaf's expected value given a feature subset S follows the row for
    features in S and the training cover fractions for the others; features
    off the leaf's path are dummy players.  With z_i (1 if the row follows the path at
    feature i, else 0) and r_i (the cover fraction), the Shapley value of feature j is
    v (z_j − r_j) ∫₀¹ Π_{i≠j} (t z_i + (1 − t) r_i) dt: the path's polynomial has
    degree k − 1 in t, so ⌈k/2⌉ Gauss–Legendre points integrate it exactly, k² terms
    a leaf instead of 2^k.  The contributions depend on z only: with fewer than
    rows of these patterns (2^k) they are computed once a pattern and looked up by the
    rows.  Returns (phi rows × features, base value), in log-odds
    units (``scale`` = 2 for the margin of ``GBTClassifier``)."""
    import numpy as np
    n = X.shape[0]
    phi = np.zeros((n_features, n))
    base = 0.0
    X = np.asfortranarray(X)
    for w, leaves in trees:
        sides = {}  # a node's comparison serves all leaves below it
        for value, path in leaves:
            z_by, r_by = {}, {}
            for f, thr, left, frac in path:
                if (f, thr, left) not in sides:
                    sides[f, thr, left] = (X[:, f] <= thr) if left else (X[:, f] > thr)
                go = sides[f, thr, left]
                z_by[f] = z_by[f] & go if f in z_by else go
                r_by[f] = r_by.get(f, 1.0) * frac
            k, v = len(z_by), scale * w * value
            base += v * float(np.prod(list(r_by.values()))) if k else v
            if not k:
                continue
            feats = list(z_by)
            if 2 ** k < n:
                z = (np.arange(2 ** k) >> np.arange(k)[:, None] & 1).astype(np.float64)  # features × patterns
                pattern = z_by[feats[0]].astype(np.intp)
                for j, f in enumerate(feats[1:], 1):
                    pattern += z_by[f].astype(np.intp) << j
            else:
                z, pattern = np.stack([z_by[f] for f in feats]).astype(np.float64), slice(None)  # features × rows
            r = np.array([r_by[f] for f in feats])[:, None]
            part = np.zeros(z.shape)
            for x, weight in zip(*np.polynomial.legendre.leggauss((k + 1) // 2), strict=True):
                t = (x + 1) / 2
                terms = t * z + (1 - t) * r
                before = np.ones(z.shape)  # products of the features before and after each one
                np.cumprod(terms[:-1], axis=0, out=before[1:])
                after = np.ones(z.shape)
                after[:-1] = np.cumprod(terms[:0:-1], axis=0)[::-1]
                part += weight / 2 * before * after
            part *= v * (z - r)
            for j, f in enumerate(feats):
                phi[f] += part[j][pattern]
    return phi.T, base


def tree_attributions(df, model, features, id_col: str):
    """E13 (tree form): per-row attributions of a fitted ensemble (``BoostedTrees``
    or a ``GBTClassifier`` pipeline), columns ``shap_<feature>`` and ``base_value``
    (log-odds).  The flattened trees travel with the task closure (bounded by the
    model size); rows are processed in Arrow batches by ``mapInPandas``.  A missing
    value goes left."""
    from pyspark.sql import types as T
    offset, scale, trees = tree_arrays(model if isinstance(model, BoostedTrees) else model.stages[-1])
    feats = list(features)
    schema = T.StructType([df.schema[id_col]] + [T.StructField(f"shap_{f}", T.DoubleType()) for f in feats]
                          + [T.StructField("base_value", T.DoubleType())])

    def run(batches):
        import numpy as np
        import pandas as pd
        for pdf in batches:
            X = pdf[feats].astype("float64").to_numpy()
            phi, base = tree_shap_batch(np.where(np.isnan(X), -np.inf, X), trees, len(feats), scale)
            out = pd.DataFrame(phi, columns=[f"shap_{f}" for f in feats])
            out.insert(0, id_col, pdf[id_col].to_numpy())
            out["base_value"] = base + offset
            yield out

    return df.select(id_col, *[F.col(f).cast("double").alias(f) for f in feats]).mapInPandas(run, schema)
