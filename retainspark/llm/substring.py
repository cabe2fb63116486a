"""Exact substring deduplication with Rabin-Karp hashes of word windows.

Every ``window`` consecutive words of a document make a window.  Of equal
windows the earliest stays (smallest id, then smallest start) and the words
covered by any other occurrence are removed; overlapping removed windows merge
into maximal intervals.

All windows are hashed, but shuffling them all would move several times the
input.  Windows are therefore represented by anchors: the ``ANCHOR``-word gram
of smallest hash inside the window.  Equal windows have equal anchors, so

1. anchors (about one per eight words) are counted in Spark, with map-side
   combine; windows whose anchor occurs once are unique and go no further;
2. the others travel as one row per run of windows with the same anchor, holding
   the run's window hashes; windows are equal when anchor hash and window hash
   are (128 bits), and a window function finds each one's first occurrence;
3. what is not first goes back to its document as bit masks.

Before step 2's shuffle each Arrow batch keeps only its own first occurrence of
a window, so a passage in very many documents sends a row per batch and not per
document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from retainspark.llm.common import binary_values, by_bytes, id_key, materialise, require, text_bytes

#: Words of an anchor gram (more for windows over 36 words: a run's windows fit
#: in the 31 bits of a mask; fewer for windows that are shorter).
ANCHOR = 6
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_ANCHOR = np.uint64(0xD6E8FEB86659FD93)
#: Words remembered with their hashes by one Python worker.
MEMO = 1_000_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def rolling(values: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash (polynomial in ``base`` modulo 2^64) of every ``size``
    consecutive values; position i holds the window that starts at i."""
    n = len(values) - size + 1
    out = np.zeros(max(0, n), dtype=np.uint64)
    for j in range(size if n > 0 else 0):
        out = out * base + values[j:j + n]
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding_argmin(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the (leftmost) minimum of every ``size`` values, by doubling."""
    at, span = np.arange(len(values) if len(values) >= size else 0), 1
    while span < size and len(at):
        step = min(span, size - span)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        span += step
    return at


class Runs:
    """Windows of one batch of texts, grouped into runs of one anchor each."""

    def __init__(self, texts: list[bytes], window: int):
        k = min(window, max(ANCHOR, window - 30))
        split = [t.split() for t in texts]
        sizes = np.array([len(w) for w in split], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        values = word_hashes([w for ws in split for w in ws])
        self.hashes = rolling(values, window, BASE)
        gram = _mix(rolling(values, k, BASE_ANCHOR))
        at = _sliding_argmin(gram, window - k + 1)
        per_doc = np.maximum(sizes - window + 1, 0)
        doc = np.repeat(np.arange(len(texts)), per_doc)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        place = np.repeat(starts, per_doc) + within  # a window's first word in the batch
        at = at[place]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])
        self.first = np.flatnonzero(new)  # of each run, among the windows
        self.length = np.diff(np.append(self.first, len(doc)))
        self.doc, self.pos, self.place = doc[self.first], within[self.first], place[self.first]
        self.anchor = gram[at[self.first]].view(np.int64) if len(doc) else np.empty(0, np.int64)


def _distinct(b: pa.RecordBatch) -> pa.RecordBatch:
    """The first of the rows that are equal in columns 0 and 1, id and tie."""
    ids, ties = b.column(0).to_numpy(), b.column(1).to_numpy()
    order = np.lexsort((ties, ids))
    same = (ids[order][1:] == ids[order][:-1]) & (ties[order][1:] == ties[order][:-1])
    return b.take(pa.array(np.sort(order[np.append(True, ~same)]))) if same.any() else b


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """``(anchor, id, tie, again)``: the distinct anchors of each row of ``docs``;
    ``again`` if one makes several runs in it.  Rows equal in id and tie are one
    within a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 2):
            b = _distinct(b)
            runs = Runs(binary_values(b.column(2)), window)
            ids, ties = b.column(0).to_numpy(), b.column(1).to_numpy()
            order = np.lexsort((runs.anchor, runs.doc))
            doc, anchor, length = runs.doc[order], runs.anchor[order], runs.length[order]
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
            first = np.flatnonzero(new)
            again = np.diff(np.append(first, len(doc))) > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[first]), pa.array(ids[doc[first]]), pa.array(ties[doc[first]]), pa.array(again)],
                names=["anchor", "id", "tie", "again"])

    return docs.select("__id", "__tie", "__t").mapInArrow(run, "anchor long, id long, tie long, again boolean")


def _candidates(marked: DataFrame, window: int) -> DataFrame:
    """Runs with a repeated anchor.  ``hashes`` and ``at`` (offset in the run)
    list the batch's first occurrences; ``gone`` masks the others, which are
    known to be removed already.  A row equal in id and tie to one before it is
    that row again and no later place of its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 2):
            b = _distinct(b)
            texts, ids, ties = binary_values(b.column(2)), b.column(0).to_numpy(), b.column(1).to_numpy()
            runs = Runs(texts, window)
            bounds = np.searchsorted(runs.doc, np.arange(len(texts) + 1))
            kept = np.concatenate([lo + np.flatnonzero(np.isin(runs.anchor[lo:hi], m.values.to_numpy()))
                                   for lo, hi, m in zip(bounds[:-1], bounds[1:], b.column(3), strict=True)])
            # earliest first, so that a batch's first occurrence of a window is its earliest
            kept = kept[np.lexsort((runs.pos[kept], ties[runs.doc[kept]], ids[runs.doc[kept]]))]
            length = runs.length[kept]
            owner = np.repeat(np.arange(len(kept)), length)
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
            h = runs.hashes[np.repeat(runs.place[kept], length) + offset]
            a = np.repeat(runs.anchor[kept], length)
            order = np.lexsort((np.arange(len(h)), h, a))
            fresh = np.ones(len(h), dtype=bool)
            same = (h[order][1:] == h[order][:-1]) & (a[order][1:] == a[order][:-1])
            fresh[order[1:][same]] = False
            gone = np.bincount(owner[~fresh], weights=2.0 ** offset[~fresh], minlength=len(kept)).astype(np.int64)
            lists = np.append(0, np.cumsum(np.bincount(owner[fresh], minlength=len(kept)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(runs.anchor[kept]), pa.array(ids[runs.doc[kept]]), pa.array(ties[runs.doc[kept]]),
                pa.array(runs.pos[kept].astype(np.int32)), pa.array(gone.astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(lists), pa.array(h[fresh].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(lists), pa.array(offset[fresh].astype(np.int8))),
            ], names=["anchor", "id", "tie", "pos", "gone", "hashes", "at"])

    return marked.mapInArrow(run, "anchor long, id long, tie long, pos int, gone int, "
                                  "hashes array<long>, at array<tinyint>")


def _removed(docs: DataFrame, window: int) -> DataFrame:
    """``(__id, __tie, runs)``: per row, equal ones as one, the masked runs of
    windows that occur earlier."""
    anchors = materialise(_anchors(docs, window), "anchors")
    repeated = (anchors.groupBy("anchor")
                .agg(F.sum(F.when(F.col("again"), 2).otherwise(1)).alias("n"))
                .filter("n > 1").select("anchor"))
    marks = materialise(anchors.join(repeated, "anchor").groupBy(F.col("id").alias("__id"), F.col("tie").alias("__tie"))
                        .agg(F.collect_set("anchor").alias("marks")), "marks")
    runs = _candidates(docs.join(marks, ["__id", "__tie"]).select("__id", "__tie", "__t", "marks"), window)
    # what a batch has settled alone needs no company
    place = F.when(F.size("hashes") > 0, F.col("anchor")).otherwise(F.xxhash64("id", "tie", "pos"))
    flat = (runs.withColumn("place", place).repartition("place")
            .withColumn("w", F.explode_outer(F.arrays_zip("hashes", "at")))
            .select("place", "id", "tie", "pos", "gone", F.col("w.hashes").alias("hash"), F.col("w.at").alias("at"))
            .withColumn("start", F.col("pos") + F.col("at")))
    here = F.struct("id", "tie", "start")
    first = F.min(here).over(W.partitionBy("place", "hash"))
    late = flat.select("place", "id", "tie", "pos", "gone", "at",
                       (F.col("hash").isNotNull() & (first < here)).alias("late"))
    return (late.groupBy("place", "id", "tie", "pos")
            .agg(F.bit_or(F.col("gone").bitwiseOR(F.when(F.col("late"), F.expr("shiftleft(1, cast(at AS int))"))
                                                  .otherwise(0))).alias("mask"))
            .filter("mask <> 0")
            .groupBy(F.col("id").alias("__id"), F.col("tie").alias("__tie"))
            .agg(F.collect_list(F.struct("pos", "mask")).alias("runs")))


def _kept(texts: list[bytes], removed: list, window: int) -> Iterator[tuple]:
    """Per text the number of words and of removed words, the removed intervals
    and the kept words."""
    for text, runs in zip(texts, removed, strict=True):
        words = text.split()
        cover = np.zeros(len(words) + 1, dtype=np.int32)
        for r in runs or ():
            for i in range(r["mask"].bit_length()):
                if r["mask"] >> i & 1:
                    cover[r["pos"] + i] += 1
                    cover[r["pos"] + i + window] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).tolist()
        spans = [{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2], strict=True)]
        if spans:
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        yield len(gone), int(gone.sum()), spans, b" ".join(words)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 20, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the added columns ``n_words``, ``n_removed``, ``spans``
    (maximal removed intervals, word positions [start, end)) and ``kept_text``
    (kept words joined by one space).  An input column of one of these names is
    replaced.

    Null and blank texts have no word and stay as they are; a text shorter than
    the window has no window.  A null id counts as the smallest.  Rows of one id
    are one document's rows, in the order of a hash of their texts; rows equal
    in id and text are one and get the same result.  An empty table gives an
    empty result."""
    if window < 1:
        raise ValueError("a window needs a word")
    require(docs, [id_col, text_col])
    added = ["n_words", "n_removed", "spans", "kept_text"]
    rest = [c for c in (docs.columns if keep is None else keep) if c not in added]
    # a text moves once, under its own name if it is asked for
    moved = list(dict.fromkeys([*rest, text_col]))
    full = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(moved)], id_key(f"`{id_col}`").alias("__id"))
    text = F.col(f"c{moved.index(text_col)}").cast("binary")
    full = full.withColumn("__tie", F.xxhash64(F.coalesce(text, F.lit(b""))))
    slim = full.select("__id", "__tie", text.alias("__t"))
    removed = materialise(_removed(slim, window), "removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, len(rest)):
            cells = list(zip(*_kept(binary_values(b.column(len(rest))), b.column(len(rest) + 1).to_pylist(),
                                    window), strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(rest))], pa.array(cells[0], pa.int64()),
                 pa.array(cells[1], pa.int64()), pa.array(cells[2], SPANS),
                 pa.array(cells[3], pa.binary()).cast(pa.string())],
                names=[*[f"c{i}" for i in range(len(rest))], *added])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*[f"c{i} {kinds[c]}" for i, c in enumerate(rest)],
                        "n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept_text string"])
    out = (full.join(removed, ["__id", "__tie"], "left")
           .select(*[f"c{i}" for i in range(len(rest))], text.alias("__t"), "runs").mapInArrow(run, schema))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], *added)
