"""SimHash near-duplicates through pivot distance tables.

Each distinct fingerprint x gets the Hamming distances to 33 reference
fingerprints: a pivot P and, for each of the 32 two-bit blocks, P with that
block complemented.  By the triangle inequality two fingerprints within k bits
have no coordinate differing by more than k; pairs that do are discarded and
the survivors are verified bit by bit.

No pair is formed blindly.  ``(d(x, P) - d(x, P_j)) / 2 + 1`` is the distance of
x to P inside block j alone, so the table splits a distance over the blocks.  Two
fingerprints within k bits differ in at most k of these block coordinates; with
the blocks dealt into k + 2 groups at least two groups agree as a whole.  Each
pair of groups makes one equi-join key of the table (6 keys for k = 2).

A key shared by more than ``BUCKET`` fingerprints (a large family of near
copies) does not form its pairs.  Its members go the exact other way: within 2 m
bits means sharing a centre at most m bits from either, so each member emits its
centres and every centre links its members to the smallest one: linear in the
members, whatever the family's size, and no link is lost to connectivity.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from retainspark.llm.common import binary_values, id_key, require, text_bytes
from retainspark.llm.components import components
from retainspark.session import stable

SEED = 42
PIVOT = 0x5DEECE66D1B54A32
BLOCKS = [0b11 << (2 * j) for j in range(32)]
#: Members up to which the pairs of one key are formed (BUCKET / 2 pairs each).
BUCKET = 64


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles, repeats included; bit i is set if
    over half the shingles' XXH64 have it.  No word: 0."""
    words = text.lower().split()  # on bytes: A-Z only, ASCII blanks only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:n - 1]]
    stops = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts, stops, strict=True)],
                 dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 8192):
        bits = np.unpackbits(h[lo:lo + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shingle: int = 3) -> DataFrame:
    """``(id_col, fp, tie)``: one row per input row, ``fp`` the fingerprint as a
    signed long, ``tie`` a hash of the text that orders rows of equal ids.  A
    null text has no word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(simhash(t, shingle)) for t in binary_values(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), b.column(1)],
                                             names=[id_col, "fp", "tie"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (require(docs, [id_col, text_col])
            .select(F.col(f"`{id_col}`"), _tie(text_col).alias("tie"), text_bytes(text_col).alias("t"))
            .mapInArrow(run, f"`{id_col}` {kind}, fp bigint, tie bigint"))


def _tie(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def pivot_table(fp: Column) -> Column:
    """Distances of a fingerprint to the 33 reference fingerprints."""
    refs = [PIVOT, *(PIVOT ^ b for b in BLOCKS)]
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(_signed(r)))).cast("tinyint") for r in refs])


def max_coordinate_difference(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def _keys(table: Column, max_bits: int) -> Column:
    """One struct (which pair of groups, their block coordinates) per key."""
    blocks = range(1, len(BLOCKS) + 1)
    groups = [[j for j in blocks if j % (max_bits + 2) == g] for g in range(max_bits + 2)]
    keys = []
    for n, (g, h) in enumerate(combinations(groups, 2)):
        code = F.lit(0).cast("long")
        for j in [*g, *h]:
            code = code * 3 + ((table[0] - table[j]) / 2 + 1).cast("long")
        keys.append(F.struct(F.lit(n).alias("n"), code.alias("code")))
    return F.array(*keys)


def near_pairs(classes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (``fp`` of ``classes``)
    that join exactly those within ``max_bits`` bits into components.  Buckets
    of up to ``BUCKET`` give every such pair; larger ones give stars."""
    if max_bits < 1:
        raise ValueError("max_bits must be at least 1; equal fingerprints are one class already")
    table = classes.select("fp", pivot_table(F.col("fp")).alias("d"))
    keyed = stable(table.select("fp", F.explode(_keys(F.col("d"), max_bits)).alias("k"))
                   .select("fp", "k.n", "k.code"))
    buckets = stable(keyed.groupBy("n", "code")
                     .agg(F.count(F.lit(1)).alias("size"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                     .filter("size > 1"))
    two = buckets.filter("size = 2").select("a", "b")
    members = stable(keyed.join(buckets.filter("size > 2").select("n", "code", "size"), ["n", "code"]))
    few = (members.filter(F.col("size") <= BUCKET)
           .groupBy("n", "code").agg(F.sort_array(F.collect_list("fp")).alias("fps")))
    some = (few.select(F.posexplode("fps").alias("i", "a"), "fps")
            .select("a", F.explode(F.slice("fps", F.col("i") + 2, F.size("fps"))).alias("b")))
    candidates = (two.union(some).distinct()
                  .withColumns({"da": pivot_table(F.col("a")), "db": pivot_table(F.col("b"))}))
    links = (candidates
             .filter(max_coordinate_difference(F.col("da"), F.col("db")) <= max_bits)
             .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
             .select("a", "b"))
    crowded = members.filter(F.col("size") > BUCKET).select("fp").distinct()
    return links.union(_stars(crowded, max_bits))


def _stars(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links of the crowded fingerprints through shared centres.  For an odd
    bound the centre is one bit further on one side, so the star's edges are
    verified and the centres of both radii meet."""
    radius = (max_bits + 1) // 2
    masks = [sum(1 << i for i in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    flips = F.array(*[F.lit(_signed(m)) for m in masks])
    centres = stable(crowded.select("fp", F.explode(flips).alias("m"))
                     .select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("centre")))
    if max_bits % 2 == 0:
        hubs = (centres.groupBy("centre").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("centre", "hub"))
        return (centres.join(hubs, "centre").filter("fp <> hub")
                .select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct())
    # odd: a point within radius r - 1 of the centre meets every one within r
    inner = crowded.select(F.col("fp").alias("hub"), F.explode(F.array(*[
        F.lit(_signed(m)) for m in masks if m.bit_count() < radius])).alias("m"))
    inner = inner.select("hub", F.col("hub").bitwiseXOR(F.col("m")).alias("centre"))
    inner = inner.groupBy("centre").agg(F.min("hub").alias("hub"))
    return (centres.join(inner, "centre").filter("fp <> hub")
            .select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct())


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """``(id_col, fp, tie, label)`` per row; ``label`` names the component."""
    fps = stable(with_fingerprints(docs, id_col, text_col, shingle))
    classes = stable(fps.select("fp").distinct())
    labels = components(near_pairs(classes, max_bits))
    by_class = (classes.join(labels, classes["fp"] == labels["node"], "left")
                .select("fp", F.coalesce("label", "fp").alias("label")))
    # a text of very many copies is one hot fingerprint: an adaptive join can split it
    return fps.join(by_class, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: ``id_col``, ``fp`` (signed long) and
    ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits, itself included.

    Null or blank texts have fingerprint 0 and link like any other.  A null id
    never names a component unless all its members' ids are null.  Repeated rows
    keep their own rows in one component.  Columns other than the two named are
    not read; an empty table gives an empty result."""
    rows = stable(_labelled(docs, id_col, text_col, shingle, max_bits))
    smallest = rows.groupBy("label").agg(F.min(id_col).alias("component_id"))
    return rows.join(smallest, "label").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Of each component one row: the smallest id (null before any), of equal
    ids the smallest hash of the text, of rows equal in both any one.  All
    columns are kept."""
    found = _labelled(docs, id_col, text_col, shingle, max_bits)
    kept = (found.select("label", id_key(id_col).alias("__id"), F.col("tie").alias("__tie"))
            .groupBy("label").agg(F.min(F.struct("__id", "__tie")).alias("k")).select("k.*"))
    keyed = docs.withColumns({"__id": id_key(id_col), "__tie": _tie(text_col)})
    return (keyed.join(kept, ["__id", "__tie"], "left_semi")
            .dropDuplicates(["__id", "__tie"]).drop("__id", "__tie"))
