"""Boosted trees from distributed gradient histograms.

Rows are binned once (quantile edges from Spark's mergeable sketch) and kept as cached
blocks of bytes, one a partition, with the margins of every model.  Models that are
trained together, the folds of a cross-validation or the arms of a T-learner, share
every job:

* a job sums gradients, Hessians and counts by (model, node, feature, bin) in each
  task and gives the driver one array a task (beyond ``FAN_IN`` tasks combined in a
  tree), whose size depends on nodes, features and bins, not on rows;
* trees grow leaf-wise: the leaf of greatest gain is split next, up to ``leaves``.  A job
  fetches the histograms of a level ahead, so there is about one job a level; of two
  siblings the smaller is summed, the other is the difference to their parent;
* the first job of a round also gives the hold-out loss, and a model stops in the
  loop once ``patience`` rounds bring no better one.  It keeps its best prefix of
  trees: nothing is fitted twice.

There are hundreds of rounds of some six jobs, so a job's fixed cost counts: there are
no more partitions than cores as long as a partition stays under ``MOST_ROWS``, and
jobs run on the blocks' RDD, without a plan to analyse and optimise for each.
The blocks are written anew, with margins that have all trees, once there are ``ADVANCE``
new trees; until then a task adds these few to its copy of the margins, which costs less
than the blocks' way through a second Python process and back.  They are checkpointed
about every ``CHECKPOINT`` rounds, so a lost executor costs the trees since then on its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stable

# Parameters of the churn model.
PARAMS = dict(rounds=500, leaves=31, rate=0.05, feature_fraction=0.9, bagging_fraction=0.8,
              bagging_every=5, min_rows=20, min_hessian=1e-3, bins=64, max_depth=6, seed=42)
BLOCK_ROWS = 8192
LEAST_ROWS = 16384
MOST_ROWS = 524288
ADVANCE = 5
CHECKPOINT = 25
FAN_IN = 32


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf's feature is −1.  ``edge`` is the last bin that
    goes left, ``threshold`` the last value."""
    feature: list = field(default_factory=list)
    edge: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    rows: list = field(default_factory=list)
    gain: list = field(default_factory=list)

    def add(self, value: float, rows: float) -> int:
        for cells, x in ((self.feature, -1), (self.edge, 0), (self.threshold, 0.0), (self.left, -1), (self.right, -1),
                         (self.value, value), (self.rows, rows), (self.gain, 0.0)):
            cells.append(x)
        return len(self.feature) - 1

    def nodes_of(self, x: np.ndarray, cut: str) -> np.ndarray:
        """The leaf of every row; ``x`` holds bins (``cut`` 'edge') or values ('threshold')."""
        feature, limit = np.array(self.feature), np.array(getattr(self, cut))
        left, right = np.array(self.left), np.array(self.right)
        at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            go = x[rows, np.maximum(f, 0)] <= limit[at]
            at = np.where(inner, np.where(go, left[at], right[at]), at)


class BoostedTrees:
    """A fitted ensemble: log-odds = ``base`` + the sum of the trees' leaf values."""

    def __init__(self, features: Sequence[str], base: float, trees: list[Tree]):
        self.features, self.base, self.trees = list(features), base, trees

    def margins(self, x: np.ndarray) -> np.ndarray:
        x = np.where(np.isnan(x), -np.inf, x)  # a missing value goes left
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += np.array(t.value)[t.nodes_of(x, "threshold")]
        return out

    def probability(self) -> Column:
        """Positive-class probability as a vectorised column expression."""
        trees, features = self, self.features

        @F.pandas_udf("double")
        def predict(rows):
            import pandas as pd
            x = rows[features].to_numpy(dtype=np.float64)
            return pd.Series(1.0 / (1.0 + np.exp(-trees.margins(x))))

        return predict(F.struct(*[F.col(c).cast("double").alias(c) for c in features]))

    def node_table(self, spark: SparkSession) -> DataFrame:
        """A row per node; tree −1 holds the base margin."""
        rows = [(-1, 0, -1, 0.0, -1, -1, self.base, 0.0, 0.0)]
        for i, t in enumerate(self.trees):
            rows += [(i, j, *cells) for j, cells in enumerate(zip(
                t.feature, map(float, t.threshold), t.left, t.right, map(float, t.value), map(float, t.rows), map(float, t.gain), strict=True))]
        return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, "
                                           "value double, rows double, gain double")

    def save(self, spark: SparkSession, path: str) -> None:
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: Sequence[str]) -> BoostedTrees:
        trees: dict[int, Tree] = {}
        base = 0.0
        for r in spark.read.parquet(path).orderBy("tree", "node").collect():  # trees × nodes, a model's size
            if r["tree"] < 0:
                base = r["value"]
                continue
            t = trees.setdefault(r["tree"], Tree())
            j = t.add(r["value"], r["rows"])
            t.feature[j], t.threshold[j], t.left[j], t.right[j], t.gain[j] = r["feature"], r["threshold"], r["left"], r["right"], r["gain"]
        return cls(features, base, [trees[i] for i in sorted(trees)])


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Ascending edges per feature, at most ``bins − 2``: a value of at most edge i, and
    above edge i − 1, is in bin i + 1.  Bin 0 takes missing values."""
    probs = [i / (bins - 2) for i in range(1, bins - 2)]
    cells = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"f{i}") for i, c in enumerate(features)]
    found = df.select(*cells).approxQuantile([f"f{i}" for i in range(len(features))], [0.0, *probs, 1.0], 0.25 / bins)
    return [np.unique(x[:-1]) if x else np.zeros(0) for x in found]


def _mix(key: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit keys (a bit mixer)."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2 ** 64 - 1))
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53)


BLOCK_SCHEMA = "n int, bins binary, y binary, w binary, key binary, train binary, valid binary"


def _partitions(spark: SparkSession, rows: int) -> int:
    """A partition a core, within ``LEAST_ROWS`` and ``MOST_ROWS`` rows each."""
    return max(1, min(spark.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS)), -(-rows // MOST_ROWS))


def _blocks(df: DataFrame, features, label, weight, train, valid, edges, key, partitions: int) -> DataFrame:
    """The rows as blocks of bytes, bins feature by feature."""
    width = len(features)
    cells = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    flag = lambda c: F.coalesce(c, F.lit(False)) if c is not None else F.lit(False)
    rows = df.select(*cells, F.col(label).cast("double").alias("y"), F.coalesce(weight, F.lit(1.0)).cast("double").alias("w"),
                     F.xxhash64(key).alias("key"), F.array(*map(flag, train)).alias("train"), F.array(*map(flag, valid)).alias("valid"))
    rows = rows.where("y IS NOT NULL").repartition(partitions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                b = whole.slice(at, BLOCK_ROWS)
                n = b.num_rows
                bins = np.zeros((width, n), dtype=np.uint8)
                for i in range(width):
                    x = b.column(i).to_numpy(zero_copy_only=False).astype(np.float64)
                    bins[i] = np.where(np.isnan(x), 0, np.searchsorted(edges[i], x, "left") + 1)
                y, w, k = (b.column(width + i).to_numpy(zero_copy_only=False) for i in range(3))
                masks = [b.column(width + i).flatten().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes() for i in (3, 4)]
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([n], pa.int32()), "bins": [bins.tobytes()], "y": [y.astype("<f8").tobytes()], "w": [w.astype("<f8").tobytes()],
                    "key": [k.astype("<i8").tobytes()], "train": [masks[0]], "valid": [masks[1]]})

    return stable(rows.mapInArrow(run, BLOCK_SCHEMA))


class _Block:
    """A partition's rows: bins by feature, and what each model needs of them."""

    CELLS = (("bins", np.uint8), ("y", "<f8"), ("w", "<f8"), ("key", "<i8"), ("train", np.uint8), ("valid", np.uint8), ("margin", "<f8"))

    def __init__(self, cells: tuple, width: int, models: int):
        self.width, self.models = width, models
        for (name, kind), x in zip(self.CELLS, cells, strict=True):
            setattr(self, name, np.frombuffer(x, dtype=kind))
        n = len(self.y)
        self.bins = self.bins.reshape(width, n)
        self.train, self.valid, self.margin = (x.reshape(models, n) for x in (self.train, self.valid, self.margin))

    @classmethod
    def joined(cls, rows: Iterator, width: int, models: int) -> tuple:
        """The cells of one block from those of a partition's rows, margins zero."""
        rows = list(rows)
        n = sum(r["n"] for r in rows)
        bins = np.empty((width, n), np.uint8)
        masks = {c: np.empty((models, n), np.uint8) for c in ("train", "valid")}
        at = 0
        for r in rows:
            to = slice(at, at := at + r["n"])
            bins[:, to] = np.frombuffer(r["bins"], np.uint8).reshape(width, -1)
            for c, x in masks.items():
                x[:, to] = np.frombuffer(r[c], np.uint8).reshape(-1, models).T
        return (bins.tobytes(), *(b"".join(r[c] for r in rows) for c in ("y", "w", "key")),
                *(x.tobytes() for x in masks.values()), bytes(8 * n * models))

    def loss(self, m: int, base: float) -> tuple[float, float]:
        """Weighted hold-out loss of a model as it is, and the weight."""
        v = np.flatnonzero(self.valid[m])
        z, w = self.margin[m][v] + base, self.w[v]
        return float((w * (np.logaddexp(0.0, z) - self.y[v] * z)).sum()), float(w.sum())

    def histograms(self, m: int, base: float, inside: np.ndarray, tree: Tree, parent: dict[int, int], nodes: list[int],
                   columns: np.ndarray, n_bins: int) -> np.ndarray:
        """Sums over the bagged rows of the nodes: node, feature, bin, (gradient, Hessian, rows)."""
        known = {0: np.flatnonzero(self.train[m] & inside)}

        def members(n: int) -> np.ndarray:
            if n not in known:
                up = parent[n]
                rows = members(up)
                left = self.bins[tree.feature[up]][rows] <= tree.edge[up]
                known[tree.left[up]], known[tree.right[up]] = rows[left], rows[~left]
            return known[n]

        parts = [members(n) for n in nodes]
        rows = np.concatenate(parts)
        chance = 1.0 / (1.0 + np.exp(-(self.margin[m][rows] + base)))
        w = self.w[rows]
        g, h = (chance - self.y[rows]) * w, chance * (1 - chance) * w
        slot = np.repeat(np.arange(len(nodes)) * n_bins, [len(r) for r in parts])
        out = np.zeros((len(nodes), self.width, n_bins, 3))
        for f in columns.tolist():
            at = slot + self.bins[f][rows]
            for k, weights in enumerate((g, h, None)):
                out[:, f, :, k] = np.bincount(at, weights, len(nodes) * n_bins).reshape(len(nodes), n_bins)
        return out

    def advance(self, recent: list[dict[int, Tree]], chosen: np.ndarray | None = None) -> None:
        """Add the rounds' trees (by model) to the margins, of all rows or the chosen ones."""
        if recent:
            self.margin = self.margin.copy()
        for m in {m: None for grown in recent for m in grown}:
            own = self.train[m] | self.valid[m]
            start = np.flatnonzero(own if chosen is None else own & chosen)
            for t in (grown[m] for grown in recent if m in grown):
                todo = [(0, start)]
                while todo:
                    n, rows = todo.pop()
                    if t.feature[n] < 0:
                        self.margin[m][rows] += t.value[n]
                        continue
                    left = self.bins[t.feature[n]][rows] <= t.edge[n]
                    todo += [(t.left[n], rows[left]), (t.right[n], rows[~left])]


def _summed(parts: RDD) -> np.ndarray:
    """The sum of the partitions' arrays, given as bytes."""
    add = lambda a, b: (np.frombuffer(a) + np.frombuffer(b)).tobytes()
    if parts.getNumPartitions() > FAN_IN:
        return np.frombuffer(parts.treeReduce(add))
    return sum(map(np.frombuffer, parts.collect()))


class _Grower:
    """One model's tree of the present round."""

    def __init__(self, p: dict, columns: np.ndarray, edges: list[np.ndarray]):
        self.p, self.columns, self.edges = p, columns, edges
        self.tree = Tree()
        self.tree.add(0.0, 0.0)
        self.histogram: dict[int, np.ndarray] = {}
        self.best: dict[int, tuple] = {}
        self.depth = {0: 0}
        self.shadow: dict[int, tuple[int, int]] = {}  # children made ahead of their parent's split
        self.parent: dict[int, int] = {}
        self.leaves = {0}
        self.done = False

    def wanted(self) -> list[int]:
        """Nodes whose histogram the next job has to sum; grows as far as none is needed."""
        while not self.done:
            nodes = self._ahead()
            if nodes:
                return nodes
            self.take({})
        return []

    def _ahead(self) -> list[int]:
        """All nodes below which nothing is known yet, split or not: the next level."""
        below = sorted((n for n in self.best if n not in self.shadow), key=lambda n: -self.best[n][0])
        out = []
        for n in below[:self.p["leaves"]]:
            self._children(n)
            a, b = self.shadow[n]
            if self.depth[a] < self.p["max_depth"]:
                out.append(a if self.tree.rows[a] <= self.tree.rows[b] else b)
        return out

    def _children(self, n: int) -> None:
        gain, f, edge, left, right = self.best[n]
        t = self.tree
        a, b = t.add(self._value(left), float(left[2])), t.add(self._value(right), float(right[2]))
        self.depth[a] = self.depth[b] = self.depth[n] + 1
        self.shadow[n] = (a, b)
        self.parent[a] = self.parent[b] = n
        t.feature[n], t.edge[n], t.threshold[n], t.left[n], t.right[n], t.gain[n] = f, edge, float(self.edges[f][edge - 1]) if edge else -np.inf, a, b, gain

    def _value(self, sums: np.ndarray) -> float:
        return float(-sums[0] / (sums[1] + 1e-12) * self.p["rate"])

    def take(self, found: dict[int, np.ndarray]) -> None:
        """Use the histograms that were asked for, then split leaves in order of their gain."""
        known = dict(found)
        for n, h in found.items():
            if n in self.parent:
                parent = self.parent[n]
                a, b = self.shadow[parent]
                known[a if b == n else b] = self.histogram[parent] - h
        self._know(known)
        if 0 in found:
            sums = found[0][self.columns[0]].sum(axis=0)
            self.tree.value[0], self.tree.rows[0] = self._value(sums), float(sums[2])
        while len(self.leaves) < self.p["leaves"]:
            ready = [n for n in self.leaves if n in self.best]
            if not ready:
                self.done = True
                return
            n = max(ready, key=lambda k: (self.best[k][0], -k))
            if n not in self.shadow:
                return  # its children are fetched by the next job
            self.leaves.remove(n)
            self.leaves.update(self.shadow[n])
        self.done = True

    def _know(self, known: dict[int, np.ndarray]) -> None:
        """Keep the nodes' histograms and find their best splits, all nodes at once."""
        self.histogram |= known
        nodes = [n for n in known if self.depth[n] < self.p["max_depth"]]
        if not nodes:
            return
        h = np.stack([known[n][self.columns] for n in nodes])
        total = h[:, 0].sum(axis=1)[:, None, None]
        left = h.cumsum(axis=2)[:, :, :-1]  # nodes × features × edges × (gradient, Hessian, rows)
        right = total - left
        score = lambda s: s[..., 0] ** 2 / (s[..., 1] + 1e-12)
        gain = score(left) + score(right) - score(total)
        low = np.minimum(left[..., 1:], right[..., 1:])
        gain[(low[..., 1] < self.p["min_rows"]) | (low[..., 0] < self.p["min_hessian"])] = 0.0
        for k, n in enumerate(nodes):
            i, edge = np.unravel_index(int(gain[k].argmax()), gain[k].shape)
            if gain[k, i, edge] > 1e-9:
                self.best[n] = (float(gain[k, i, edge]), int(self.columns[i]), int(edge), left[k, i, edge], right[k, i, edge])

    def finish(self) -> Tree:
        """The tree without the nodes that were only looked at."""
        out = Tree()

        def copy(n: int) -> int:
            j = out.add(self.tree.value[n], self.tree.rows[n])
            if n not in self.leaves:
                for name in ("feature", "edge", "threshold", "gain"):
                    getattr(out, name)[j] = getattr(self.tree, name)[n]
                out.left[j], out.right[j] = copy(self.tree.left[n]), copy(self.tree.right[n])
            return j

        copy(0)
        return out


def fit(df: DataFrame, features: Sequence[str], label: str, train: Sequence[Column], key: str,
        weight: Column | None = None, valid: Sequence[Column | None] | None = None, patience: int | None = None,
        **params) -> list[BoostedTrees]:
    """One model per entry of ``train`` (which rows it learns from), grown together.
    With ``valid`` (hold-out rows per model) and ``patience`` a model ends with its best
    round by the hold-out log-loss.  ``key`` identifies rows for the bagging draw.
    Rows with a null label take no part; a model without rows, or of one class, is
    its base rate."""
    p = PARAMS | params
    features, models = list(features), len(train)
    valid = list(valid) if valid is not None else [None] * models
    spark, width, bins = df.sparkSession, len(features), p["bins"]
    w = weight if weight is not None else F.lit(1.0)
    y = F.col(label).cast("double")
    sums = df.where(y.isNotNull()).agg(
        *[F.sum(F.when(c, w * y)).alias(f"p{m}") for m, c in enumerate(train)],
        *[F.sum(F.when(c, w)).alias(f"w{m}") for m, c in enumerate(train)], F.count(F.lit(1)).alias("rows")).first()
    edges = bin_edges(df, features, bins)
    rate = np.array([min(max((sums[f"p{m}"] or 0.0) / (sums[f"w{m}"] or 1.0), 1e-9), 1 - 1e-9) for m in range(models)])
    base = np.log(rate / (1 - rate))
    blocks = _blocks(df, features, label, w, train, valid, edges, F.col(key), _partitions(spark, sums["rows"]))
    join = _Block.joined
    state = blocks.rdd.mapPartitions(lambda rows: [join(rows, width, models)]).persist(StorageLevel.MEMORY_AND_DISK)
    rng = np.random.default_rng(p["seed"])
    trees: list[list[Tree]] = [[] for _ in range(models)]
    best, alive = [(float("inf"), 0)] * models, list(range(models))
    used = np.arange(bins) <= np.array([len(e) + 1 for e in edges])[:, None]  # bins that can hold a row
    per_node = int(used.sum()) * 3

    def job(growers: dict[int, _Grower], wanted: dict[int, list[int]], columns: np.ndarray, bag: int) -> tuple[dict, np.ndarray]:
        """The histograms of the wanted nodes, and in a round's first job the losses before it."""
        growing = [(m, growers[m].tree, growers[m].parent, nodes) for m, nodes in wanted.items()]
        first = any(nodes == [0] for nodes in wanted.values())
        ahead = [{m: t for m, t in grown.items() if m in wanted} for grown in recent]
        fraction, seed = p["bagging_fraction"], p["seed"]

        def run(rows: Iterator[tuple]) -> Iterator[bytes]:
            for cells in rows:
                x = _Block(cells, width, models)
                inside = _mix(x.key, seed + bag) < fraction
                x.advance(ahead, None if first else inside)
                out = [x.loss(m, base[m]) if nodes == [0] else (0.0, 0.0) for m, _, _, nodes in growing]
                yield np.concatenate([np.array(out).reshape(-1), *(
                    x.histograms(m, base[m], inside, tree, parent, nodes, columns, bins)[:, used].reshape(-1)
                    for m, tree, parent, nodes in growing)]).tobytes()

        found = _summed(state.mapPartitions(run))
        at, out = 2 * len(wanted), {}
        for m, nodes in wanted.items():
            h = np.zeros((len(nodes), width, bins, 3))
            h[:, used] = found[at:at + len(nodes) * per_node].reshape(len(nodes), -1, 3)
            at += len(nodes) * per_node
            out[m] = dict(zip(nodes, h, strict=True))
        return out, found[:2 * len(wanted)].reshape(-1, 2)

    rounds, kept, recent = 0, 0, []  # recent: the trees that the blocks' margins do not have yet
    while alive:
        columns = np.sort(rng.permutation(width)[:max(1, round(p["feature_fraction"] * width))])
        growers = {m: _Grower(p, columns, edges) for m in alive}
        bag = rounds // p["bagging_every"]
        old = state
        if sum(map(len, recent)) >= ADVANCE:
            state, recent = _advance(old, width, models, recent).persist(StorageLevel.MEMORY_AND_DISK), []
            if rounds >= kept + CHECKPOINT:
                state.checkpoint()
                kept = rounds
        first, losses = job(growers, {m: [0] for m in alive}, columns, bag)
        if state is not old:
            old.unpersist()
        for m, (loss, weight) in zip(alive, losses, strict=True):
            if weight > 0 and loss / weight < best[m][0]:
                best[m] = (loss / weight, len(trees[m]))
        if patience:
            alive = [m for m in alive if best[m][0] == float("inf") or len(trees[m]) - best[m][1] < patience]
        alive = [m for m in alive if len(trees[m]) < p["rounds"]]
        for m in alive:
            growers[m].take(first[m])
        while wanted := {m: nodes for m in alive if (nodes := growers[m].wanted())}:
            for m, found in job(growers, wanted, columns, bag)[0].items():
                growers[m].take(found)
        for m in alive:
            trees[m].append(growers[m].finish())
        recent.append({m: trees[m][-1] for m in alive})
        rounds += 1
        if not patience:
            alive = [m for m in alive if len(trees[m]) < p["rounds"]]
    state.unpersist()
    keep = [best[m][1] if patience and best[m][0] < float("inf") else len(trees[m]) for m in range(models)]
    return [BoostedTrees(features, float(base[m]), trees[m][:max(keep[m], 1)]) for m in range(models)]


def _advance(state: RDD, width: int, models: int, recent: list[dict[int, Tree]]) -> RDD:
    """The blocks with the rounds' trees added to their margins."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for cells in rows:
            x = _Block(cells, width, models)
            x.advance(recent)
            yield (*cells[:-1], x.margin.tobytes())

    return state.mapPartitions(run)
