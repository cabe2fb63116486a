"""Packing documents into windows by non-negative least squares.

A document's ids are cut into whole windows, a body that is a multiple of ``grain``
ids and a tail shorter than that.  Bodies have at most ``window / grain - 1``
lengths, so their histogram is a row per length whatever the table's size.  On the
driver:

1. every combination of at most ``depth`` body lengths that fills a window exactly
   is a column of a matrix A (its rows are the lengths);
2. non-negative least squares finds repeat counts x with A x near the histogram;
3. counts are rounded, never above what is there, and a greedy pass adds whole
   combinations from what rounding has left.

In Spark each body takes the slot that its rank among the bodies of its length
gives.  Bodies without a slot and all tails are packed greedily, one behind the
other, cut at window ends; the last rest is cut into sequences of powers of two.  So
every sequence is full, or its length is a power of two.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from array import array
from collections import ChainMap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from retainspark.llm.common import by_bytes, materialise, require, text_bytes
from retainspark.operators.ranking import global_running_sum

WINDOW, GRAIN, DEPTH = 2048, 32, 4
#: Chunks whose ids one Python worker remembers, and their greatest length in bytes.
MEMO, MEMO_BYTES = 400_000, 64
#: Bytes of texts that are encoded together.
SLICE = 4 << 20

_LETTER = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"  # a to z and U+00C0 to U+00FF without the two signs
_SIGN = rb"[!-&(-@\[-`{-~]"  # ASCII but letters, blanks and the apostrophe
_BLANK = rb"[ \t\n\r\x0b\x0c]"
#: Chunks in which a lower-cased text's bytes are encoded one by one.  Letters and signs
#: part where they meet; next to any other character the rest up to the blank stays
#: together.
_CHUNKS = re.compile(rb"%b+(?=%b|%b|\Z)|%b+(?=[a-z\xc3]|%b|\Z)(?!\xc3[\x97\xb7])|[^ \t\n\r\x0b\x0c]+" % (_LETTER, _SIGN, _BLANK, _SIGN, _BLANK))

#: Words of lower-case letters, of U+00E0 to U+00FF without the sign among them.
_WORD = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+")


class ChunkEncoder:
    """Ids of whole texts for a vocabulary that lower-cases, drops white space and never
    joins letters with signs: a text's ids are those of its chunks, one after another."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        probe = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("a, b", " A\t,\n b ", "a", ",", "b")]
        if not probe[0] == probe[1] == probe[2] + probe[3] + probe[4]:
            raise ValueError("the vocabulary keeps case, white space, or letters and signs together")
        # the byte-level alphabet's spelling of the letters in _WORD, as the library gives it
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.model, self.letters = self.tokenizer.model, {n: spell(chr(n))[0][0] for n in range(0xE0, 0x100)}
        self.memo: dict[bytes, bytes] = {}

    def _library(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of every chunk.  A word of letters that no normaliser changes goes to the
        library's model, anything else through its whole chain."""
        out = [b""] * len(chunks)
        tokenize, letters, rest = self.model.tokenize, self.letters, []
        for i, c in enumerate(chunks):
            if _WORD.fullmatch(c):
                word = c.decode("ascii") if c.isascii() else c.decode().translate(letters)
                out[i] = array("I", [t.id for t in tokenize(word)]).tobytes()
            else:
                rest.append(i)
        texts = [chunks[i].decode("utf-8", "replace") for i in rest]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            out[i] = array("I", e.ids).tobytes()
        return out

    def _words(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word; chunks that were met before come from memory."""
        got = list(map(self.memo.get, words))  # words without signs are chunks
        rest = [i for i, x in enumerate(got) if x is None]
        split = [_CHUNKS.findall(words[i]) for i in rest]
        used = set(itertools.chain.from_iterable(split))
        new = list(used.difference(self.memo))
        ids = dict(zip(new, self._library(new), strict=True))
        known = ChainMap(ids, self.memo) if any(len(c) > MEMO_BYTES for c in new) else self.memo
        self.memo.update((c, x) for c, x in ids.items() if len(c) <= MEMO_BYTES)  # long chunks are not remembered
        for i, parts in zip(rest, split, strict=True):
            got[i] = b"".join(map(known.__getitem__, parts))
        if len(self.memo) > MEMO:  # the chunks of this slice, the frequent ones among them, stay
            used.update(words)
            self.memo = {c: x for c, x in self.memo.items() if c in used}
        return got

    def encode(self, texts: pa.Array, end: bytes = b"") -> list[bytes]:
        """The ids of every text (null as empty), followed by ``end``, as little-endian
        unsigned 32-bit integers.  Each distinct word of ``texts`` is looked up once."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        words = lists.flatten().cast(pa.binary()).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        ends = np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()
        ids = pa.array([*self._words(distinct), end], pa.large_binary())
        # the texts' words in order, an end behind each text: one gather, and a cut per text
        order = np.insert(np.asarray(words.indices).astype(np.int64), ends, len(distinct))
        taken = ids.take(pa.array(order))
        offsets = np.frombuffer(taken.buffers()[1], dtype=np.int64)[taken.offset:]
        cuts = offsets[[0, *(ends + np.arange(1, len(ends) + 1)).tolist()]].tolist()
        data = memoryview(taken.buffers()[2] or b"")
        return [bytes(data[lo:hi]) for lo, hi in itertools.pairwise(cuts)]


@functools.cache
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``(row, doc_id, ids, n)``: the ids of every whole text with the end id, as
    little-endian 32-bit integers, and their number; ``row`` is unique."""
    rows = require(docs, [id_col, text_col]).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_bytes(f"`{text_col}`").alias("t"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for b in by_bytes(batches, 1, SLICE):
            ids = own.encode(b.column(1).cast(pa.string()), end)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())],
                names=["doc_id", "ids", "n"])

    out = rows.mapInArrow(run, "doc_id long, ids binary, n long")
    return materialise(out.select(F.monotonically_increasing_id().alias("row"), "doc_id", "ids", "n"), "packing-ids")


def combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """Descending tuples of two to ``depth`` positive lengths that sum to ``units``."""
    def grow(rest: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if rest == 0:
            yield ()
        elif left:
            # the parts still to come are no longer than this one
            for k in range(min(rest, most), -(-rest // left) - 1, -1):
                for more in grow(rest - k, k, left - 1):
                    yield (k, *more)
    return [c for c in grow(units, units - 1, depth) if len(c) > 1]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 with least |a x - b|, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, dtype=bool)
    tolerance = 1e-10 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(rounds or 3 * sum(a.shape)):
        gain = np.where(passive, -np.inf, a.T @ (b - a @ x))
        if passive.all() or gain.max() <= tolerance:
            break
        passive[int(gain.argmax())] = True
        while True:
            at = np.flatnonzero(passive)
            s = np.zeros(n)
            s[at] = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            low = at[s[at] <= 0]
            if not len(low):
                break
            step = (x[low] / np.maximum(x[low] - s[low], 1e-300)).min()
            x = x + step * (s - x)
            passive &= x > 1e-12 * max(1.0, float(x.max(initial=0.0)))
            x[~passive] = 0.0
        x = s
    return x


def repeat_counts(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """How often to use which combination.  ``histogram[k]`` is the number of bodies
    of ``k`` units; its length is the window's units.  No length is used more
    often than it is there."""
    units = len(histogram)
    plans = combinations(units, depth)
    if not plans or not histogram.sum():
        return []
    a = np.zeros((units, len(plans)))
    for j, c in enumerate(plans):
        for k in c:
            a[k, j] += 1
    solved = np.rint(nnls(a, histogram.astype(float) / histogram.sum()) * histogram.sum()).astype(np.int64)
    left, counts = histogram.astype(np.int64), np.zeros(len(plans), dtype=np.int64)
    need = a.astype(np.int64)

    def take(j: int, most: int | None) -> None:
        used = need[:, j]
        room = int((left[used > 0] // used[used > 0]).min())
        k = room if most is None else min(room, most)
        counts[j] += k
        left[:] -= k * used

    for j in np.argsort(-solved, kind="stable").tolist():
        if solved[j]:
            take(j, int(solved[j]))
    for j in range(len(plans)):  # greedily, long lengths and few parts first
        take(j, None)
    return [(plans[j], int(counts[j])) for j in np.flatnonzero(counts)]


def _slots(plans: list[tuple[tuple[int, ...], int]], grain: int) -> tuple[list[tuple], dict[int, int]]:
    """Ranges of ranks: (length, first rank, last rank + 1, parts of that length in the
    combination, first sequence, offset), and the slots of each length."""
    used: dict[int, int] = {}
    out, first = [], 0
    for parts, count in plans:
        offset = 0
        for k in sorted(set(parts), reverse=True):
            m = parts.count(k)
            lo = used.get(k, 0)
            used[k] = lo + m * count
            out.append((k, lo, lo + m * count, m, first, offset))
            offset += m * k * grain
        first += count
    return out, used


def _powers(rest: int) -> list[tuple[int, int]]:
    """(start, length) of the powers of two that make up ``rest``, largest first."""
    out, at = [], 0
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def pack(lengths: DataFrame, window: int = WINDOW, grain: int = GRAIN, depth: int = DEPTH) -> DataFrame:
    """Pieces of documents given as ``(row, n)``, ``row`` unique and ``n`` their number of
    ids: ``(row, start, length, sequence_id, offset)``.  Every id lies in exactly one
    piece and the pieces of a sequence follow each other without gaps; sequences
    hold ``window`` ids or a power of two of them.

    Null or zero ``n`` has no piece; an empty table none at all.  Documents of
    equal length take slots in the order of ``row``.  A length that holds most
    documents is ranked in slices, not in one task; a very long document is a
    range of whole windows, no list."""
    if window % grain:
        raise ValueError("the window must be a multiple of the grain")
    spark, units = lengths.sparkSession, window // grain
    rows = lengths.select("row", F.col("n").cast("long").alias("n")).filter("n > 0")
    rest = F.col("n") % window
    rows = rows.withColumns({"whole": F.col("n") - rest, "units": F.floor(rest / grain).cast("int"), "tail": rest % grain})
    # a row per body length, at most window / grain of them
    counted = rows.groupBy("units").agg(F.count(F.lit(1)).alias("k")).collect()
    histogram = np.zeros(units, dtype=np.int64)
    for r in counted:
        histogram[r["units"]] = r["k"]
    histogram[0] = 0
    plans = repeat_counts(histogram, depth)
    ranges, used = _slots(plans, grain)
    packed = sum(count for _, count in plans)

    bodies = rows.filter("units > 0").select("row", "whole", "units", "tail")
    ranked = global_running_sum(bodies, [F.asc("row")], {"rank": F.lit(1)}, partition_by=["units"], exclusive=True)
    slots = spark.createDataFrame(ranges, "k int, lo long, hi long, m int, first long, at long")
    here = (F.col("units") == F.col("k")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    # at most window / grain combinations are in use by the solution, and a few by the greedy pass
    placed = ranked.join(F.broadcast(slots), here, "left")
    body = (F.col("units") * grain).cast("long")
    nth = F.col("rank") - F.col("lo")
    in_slots = placed.filter("k IS NOT NULL").select(
        "row", F.col("whole").alias("start"), body.alias("length"),
        (F.col("first") + F.floor(nth / F.col("m"))).cast("long").alias("sequence_id"),
        (F.col("at") + (nth % F.col("m")) * body).cast("long").alias("offset"))

    # what has no slot: whole bodies with their tails, and single tails
    loose = (placed.select("row", F.when(F.col("k").isNull(), F.col("whole")).otherwise(F.col("whole") + body).alias("start"),
                           F.when(F.col("k").isNull(), body + F.col("tail")).otherwise(F.col("tail")).alias("length"))
             .union(rows.filter("units = 0").select("row", F.col("whole"), F.col("tail"))).filter("length > 0"))
    stream = global_running_sum(loose, [F.asc("row")], {"pos": F.col("length")}, exclusive=True)
    total = stream.agg(F.max(F.col("pos") + F.col("length"))).first()[0] or 0
    full, rest_ids = total // window, total % window
    cuts = [(full * window + at, size) for at, size in _powers(rest_ids)]
    after = packed + full
    in_stream = _cut(stream, window, full, packed).unionByName(_cut_rest(stream, cuts, after))

    windows = rows.filter("whole > 0").select("row", F.col("whole").alias("length"))
    windows = global_running_sum(windows, [F.asc("row")], {"pos": F.col("length")}, exclusive=True)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("length") / window).cast("long") - 1))
    in_windows = windows.select("row", F.floor(F.col("pos") / window).alias("w"), each.alias("i")).select(
        "row", (F.col("i") * window).alias("start"), F.lit(window).cast("long").alias("length"),
        (F.col("w") + F.col("i") + after + len(cuts)).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return in_slots.unionByName(in_stream).unionByName(in_windows)


def _part(begin: Column, end: Column) -> list[Column]:
    """The part [begin, end) of the stream as a piece of the row that holds it."""
    return ["row", (F.col("start") + begin - F.col("pos")).alias("start"), (end - begin).alias("length")]


def _cut(stream: DataFrame, window: int, full: int, base: int) -> DataFrame:
    """Pieces of the stream in its ``full`` whole windows; loose pieces are
    shorter than a window, so each lies in two of them at most."""
    w = F.floor(F.col("pos") / window).cast("long")
    both = stream.withColumn("w", F.explode(F.array(w, w + 1)))
    begin = F.greatest(F.col("pos"), F.col("w") * window)
    end = F.least(F.col("pos") + F.col("length"), (F.col("w") + 1) * window)
    return both.filter((begin < end) & (F.col("w") < full)).select(
        *_part(begin, end), (F.col("w") + base).alias("sequence_id"), (begin - F.col("w") * window).alias("offset"))


def _cut_rest(stream: DataFrame, cuts: list[tuple[int, int]], base: int) -> DataFrame:
    """Pieces of the stream behind its whole windows, one sequence per cut."""
    table = stream.sparkSession.createDataFrame([(a, a + s, base + i) for i, (a, s) in enumerate(cuts)], "lo long, hi long, sequence_id long")
    begin, end = F.greatest("pos", "lo"), F.least(F.col("pos") + F.col("length"), F.col("hi"))
    tail = stream.filter(F.col("pos") + F.col("length") > (cuts[0][0] if cuts else 0))
    # at most log2(window) cuts
    return tail.join(F.broadcast(table), (F.col("pos") < F.col("hi")) & (F.col("pos") + F.col("length") > F.col("lo"))).select(
        *_part(begin, end), "sequence_id", (begin - F.col("lo")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW, grain: int = GRAIN,
                   depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed pieces with their ids: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian
    unsigned 32-bit integers), ``doc_tokens``, ``sequence_id``, ``offset``.

    Null texts count as empty: the end id alone.  Rows of one id, and equal rows,
    are documents of their own; null ids stay null.  Very long texts are encoded
    whole and cut in one pass.  Other columns are not
    read.  An empty table gives an empty result."""
    encoded = encode_documents(docs, tokenizer, end_id, id_col, text_col)
    pieces = pack(encoded.select("row", "n"), window, grain, depth)
    # a document's pieces, as one row of a few longs each: ids cross the shuffle once
    plan = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    part = lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"), F.substring(
        "ids", (p["start"] * 4 + 1).cast("int"), (p["length"] * 4).cast("int")).alias("ids"),
        p["sequence_id"].alias("sequence_id"), p["offset"].alias("offset"))
    out = encoded.join(plan, "row").select("doc_id", F.col("n").alias("doc_tokens"), F.explode(F.transform("pieces", part)).alias("p"))
    return out.select("doc_id", "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset")
