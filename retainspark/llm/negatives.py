"""Hard negatives by threshold joins over a pruned inverted index.

Anchors are a stated part of the rows (one of fifty, say).  A threshold join finds all
rows whose inner product with an anchor reaches the anchor's threshold, after
L2AP:

* Rows are taken in blocks, as the scan deals them.  A block's dimensions are ordered by
  energy, the weakest first.  The leading dimensions of a row whose norm alone,
  times the longest anchor, stays below every threshold are left out of the
  index.  A block's rows are sorted by how many they leave out, so the posting list of a
  dimension is a leading part of the block.
* Anchors are read from the shared folder in batches, and add up partial scores
  from the strongest dimensions down.  After each group of dimensions pairs go
  whose partial score plus the product of the remaining norms is below the
  threshold; what is left is scored in full.
* Thresholds start high and are lowered for those anchors only whose windows aren't
  full, down to where nothing more can count.

A task holds a block, a batch of anchors and their scores.  It gives a few rows an
anchor and window; Spark merges them.  Labels deal nothing, so a hot one is no group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window, functions as F

from retainspark.llm.common import materialise, require

#: Rows of a block and anchors of a batch; groups of dimensions.
BLOCK, BATCH, GROUPS = 1 << 15, 256, 16
#: Share of a batch's pairs from which on they are scored one by one.
SPARSE = 0.02
#: Thresholds of positives, in parts of the anchor's norm times the mean norm of the rows.
POSITIVE_STEPS = (0.7, 0.4, 0.15, float("-inf"))
#: Thresholds of negatives, in parts of the upper end of the lowest window.
NEGATIVE_STEPS = (0.9, 0.7, float("-inf"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix of integers; short vectors end in zeros."""
    lengths = np.asarray(column.value_lengths()).astype(np.int64)
    flat = np.asarray(column.flatten())
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _exact(longest: float) -> type:
    """The number type whose sums of products up to ``longest`` are exact."""
    return np.float32 if longest < 1 << 24 else np.float64 if longest < 1 << 53 else np.int64


class Index:
    """The inverted index of a block for scores from ``least`` times the anchor's norm on."""

    def __init__(self, vectors: np.ndarray, least: float):
        energy = (vectors.astype(np.float64) ** 2).sum(axis=0)
        self.order = np.argsort(energy, kind="stable")
        y = vectors[:, self.order]
        width = y.shape[1]
        self.bounds = np.unique(np.linspace(0, width, min(GROUPS, max(width, 1)) + 1).astype(np.int64))
        squares = np.concatenate((np.zeros((len(y), 1)), (y.astype(np.float64) ** 2).cumsum(axis=1)), axis=1)
        norms = np.sqrt(squares[:, self.bounds])
        # groups of leading dimensions that a row leaves out; their norm stays below the bound
        out = np.maximum((norms * (1 + 1e-9) < least).sum(axis=1) - 1, 0)
        self.rows = np.argsort(out, kind="stable")
        out = out[self.rows]
        self.y, self.norms = y[self.rows], norms[self.rows]
        self.postings = [int(np.searchsorted(out, j, "right")) for j in range(len(self.bounds) - 1)]
        self.longest = float(norms[:, -1].max(initial=0.0))

    def search(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs that reach the anchor's threshold."""
        x = anchors[:, self.order]
        squares = np.concatenate((np.zeros((len(x), 1)), (x.astype(np.float64) ** 2).cumsum(axis=1)), axis=1)
        norms = np.sqrt(squares[:, self.bounds])
        longest = float(norms[:, -1].max(initial=0.0)) * self.longest
        kind = _exact(longest)
        xs, ys = x.astype(kind), self.y.astype(kind)
        # partial sums are exact, norms nearly so
        floor = (thresholds - 1e-5 * longest - 1)[:, None]
        scores = np.zeros((len(xs), len(ys)), dtype=kind)
        alive = np.zeros(scores.shape, dtype=bool)  # rows that leave all out can't reach a threshold
        for j in range(len(self.bounds) - 2, -1, -1):
            lo, hi, n = self.bounds[j], self.bounds[j + 1], self.postings[j]
            scores[:, :n] += xs[:, lo:hi] @ ys[:n, lo:hi].T
            # rows further on leave this group out: their bound stays as it was
            alive[:, :n] = scores[:, :n] + norms[:, j, None] * self.norms[None, :n, j] >= floor
            if alive.mean() < SPARSE:
                break
        if not alive.any():
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        if alive.mean() < SPARSE:
            a, r = np.nonzero(alive)
            found = np.concatenate([np.einsum("ij,ij->i", xs[a[k:k + BLOCK]], ys[r[k:k + BLOCK]]) for k in range(0, len(a), BLOCK)])
        else:
            whole = xs @ ys.T
            a, r = np.nonzero(alive & (whole >= thresholds[:, None]))
            found = whole[a, r]
        found = found.astype(np.int64)
        reach = found >= thresholds[a]
        return a[reach], self.rows[r[reach]], found[reach]


def _leading(anchor: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` places of each run of equal anchors."""
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    rank = np.arange(len(anchor)) - np.repeat(starts, np.diff(np.r_[starts, len(anchor)]))
    return np.flatnonzero(rank < most)


def _windowed(anchor: np.ndarray, score: np.ndarray, low: list, high: list, most: int) -> np.ndarray:
    """The first ``most`` places of every window of each run of equal anchors, scores descending."""
    keep = []
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(anchor)], strict=True):
        falling = -score[lo:hi]
        for a, b in zip(low[anchor[lo]], high[anchor[lo]], strict=True):
            first = int(np.searchsorted(falling, -b, "left"))
            last = min(int(np.searchsorted(falling, -a, "right")), first + most)
            keep.append(np.arange(lo + first, max(lo + last, lo + first)))
    return np.unique(np.concatenate(keep)) if keep else np.zeros(0, dtype=np.int64)


def _probe_batches(files: list[str]) -> Iterator[pa.RecordBatch]:
    for uri in files:
        store, path = fs.FileSystem.from_uri(uri)
        with store.open_input_file(path) as f:
            yield from pq.ParquetFile(f).iter_batches(batch_size=BATCH)


def _join(rows: DataFrame, probes: DataFrame, same: bool, most: int) -> DataFrame:
    """``(anchor_id, id, score)``: of each block, the first ``most`` rows of the anchor's own
    label (``same``), or of other labels in each of its windows, that reach its threshold."""
    edge = probes.agg(F.min(F.when(F.col("norm") > 0, F.col("threshold") / F.col("norm")).otherwise(float("-inf"))).alias("least"),
                      F.max(F.size("vector")).alias("width")).first()
    files, least, width = probes.inputFiles(), float(edge["least"]), int(edge["width"])

    def block(part: pa.Table) -> Iterator[pa.RecordBatch]:
        part = part.combine_chunks()
        ids, labels = np.asarray(part.column("id")), np.asarray(part.column("label"))
        vectors = part.column("vector").chunk(0)
        wide = max(width, int(np.asarray(vectors.value_lengths()).max(initial=0)))
        index = Index(_matrix(vectors, wide), least)
        for b in _probe_batches(files):
            anchors, of = np.asarray(b.column("anchor_id")), np.asarray(b.column("label"))
            a, r, score = index.search(_matrix(b.column("vector"), wide), np.asarray(b.column("threshold")))
            fits = (ids[r] != anchors[a]) & (labels[r] == of[a]) if same else labels[r] != of[a]
            a, r, score = a[fits], r[fits], score[fits]
            first = np.lexsort((ids[r], -score, a))
            a, r, score = a[first], r[first], score[first]
            if not len(a):
                continue
            keep = _leading(a, most) if same else _windowed(a, score, b.column("low").to_pylist(), b.column("high").to_pylist(), most)
            yield pa.RecordBatch.from_arrays([pa.array(anchors[a[keep]]), pa.array(ids[r[keep]]), pa.array(score[keep])],
                                             names=["anchor_id", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= BLOCK:
                yield from block(pa.Table.from_batches(held))
                held = []
        if sum(x.num_rows for x in held):
            yield from block(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "anchor_id long, id long, score long")


def _first(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _fill(rows: DataFrame, probes: DataFrame, steps: tuple, threshold: Callable[[float], Column], same: bool, most: int,
          merge: Callable[[DataFrame, DataFrame], DataFrame], full: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame | None:
    """Joins with falling thresholds.  ``merge`` makes the result rows of the probes asked,
    ``full`` tells the anchors that need no lower threshold; the last step takes all."""
    done = None
    for i, step in enumerate(steps):
        asked = materialise(probes.withColumn("threshold", threshold(step)), "probes")
        if asked.isEmpty():
            break
        found = materialise(merge(_join(rows, asked, same, most), asked), "threshold-join")
        if i + 1 < len(steps):
            ready = full(found, asked)
            probes = asked.join(ready, "anchor_id", "left_anti")
            found = found.join(ready, "anchor_id", "left_semi")
        done = found if done is None else done.unionByName(found)
    return done


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))


def _window(low: int, high: int) -> list[Column]:
    """The least and the greatest whole score in a positive's window, in whole numbers."""
    lo = F.expr(f"(positive_score * {low}) div 100 + CASE WHEN (positive_score * {low}) % 100 > 0 THEN 1 ELSE 0 END")
    hi = F.expr(f"(positive_score * {high}) div 100 - CASE WHEN (positive_score * {high}) % 100 < 0 THEN 1 ELSE 0 END")
    return [lo.alias("lo"), hi.alias("hi")]


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "id", label_col: str = "label", vector_col: str = "vector") -> DataFrame:
    """Hard negatives of the ``anchors`` (``id``, ``label``, ``vector`` as in ``rows``; vectors of whole numbers).

    An anchor's positives are its ``positives`` best rows of its own label, other ids than its
    own; for each the best ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * score <= high * positive_score``.  Scores are inner
    products; ties go to the smaller id.  ``anchor_id, positive_id, rank`` (from 1)
    ``, negative_id, positive_score, negative_score``.

    Rows without id, label or vector, or with a null in the vector, take no part.  Vectors of
    unequal length end in zeros.  Rows of one id are rows of their own; anchors of one
    id count once (the least label, then vector).  Scores must fit in 64 bits.
    Positives below zero have an empty window.  Other columns are not read; empty
    tables, and anchors without a positive or a negative, give no row."""
    spark = rows.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        df = require(df, [id_col, label_col, vector_col]).toDF("id", "label", "vector")
        return df.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                         F.col("vector").cast("array<bigint>").alias("vector")).dropna().filter(~F.exists("vector", lambda v: v.isNull()))

    table = materialise(clean(rows), "vectors")
    mean = float(table.agg(F.avg(_norm(F.col("vector")))).first()[0] or 0.0)
    own = materialise(clean(anchors).groupBy(F.col("id").alias("anchor_id")).agg(F.min(F.struct("label", "vector")).alias("m"))
                      .select("anchor_id", "m.*", _norm(F.col("m.vector")).alias("norm")), "anchors")

    def enough(found: DataFrame, asked: DataFrame) -> DataFrame:
        return found.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= positives).select("anchor_id")

    best = _fill(table, own, POSITIVE_STEPS, lambda step: F.lit(step) if step < 0 else F.col("norm") * (step * mean), True, positives,
                 lambda found, asked: _first(found, ["anchor_id"], positives), enough)
    if best is None:
        return spark.createDataFrame([], RESULT)
    windows = best.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = materialise(windows.select("*", *_window(low, high)).filter("lo <= hi"), "windows")
    spans = windows.groupBy("anchor_id").agg(F.collect_list("lo").alias("low"), F.collect_list("hi").alias("high"))
    probes = own.join(spans, "anchor_id")  # at most `positives` windows an anchor

    def in_windows(found: DataFrame, asked: DataFrame) -> DataFrame:
        # an anchor's windows may overlap, so a row can count in several
        hit = found.join(windows, "anchor_id").filter("score BETWEEN lo AND hi")
        return _first(hit, ["anchor_id", "positive_id"], negatives)

    def filled(found: DataFrame, asked: DataFrame) -> DataFrame:
        counts = found.groupBy("anchor_id", "positive_id").agg(F.count(F.lit(1)).alias("n"))
        state = (windows.join(asked.select("anchor_id", "threshold"), "anchor_id").join(counts, ["anchor_id", "positive_id"], "left")
                 .withColumn("open", (F.coalesce("n", F.lit(0)) < negatives) & (F.col("lo") < F.col("threshold"))))
        return state.groupBy("anchor_id").agg(F.max("open").alias("open")).filter("NOT open").select("anchor_id")

    floor, top = F.array_min("low").cast("double"), F.array_min("high").cast("double")
    out = _fill(table, probes, NEGATIVE_STEPS, lambda step: floor if step < 0 else F.greatest(floor, top * step), False, negatives,
                in_windows, filled)
    if out is None:
        return spark.createDataFrame([], RESULT)
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                      F.col("score").alias("negative_score"))
