"""Sharding by histogram sort.

Rows are put in key order into shards of equal bytes.  The splitters are found
by counting, not by sorting: exact byte sums between candidate boundaries
(probes) of all splitters at once, then new probes inside the interval that
holds each target, until every splitter meets the tolerance.  Only a slim table
(key, size) takes part in that; afterwards the rows are exchanged once.

Each shard is made of splitter ranges, as many as the counted bytes ask for, so
that the sort and the slots of one shard spread over as many tasks and a task's
rows do not grow with the table; the ranges' exact row counts give each its first slot.
"""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from retainspark.llm.common import MIN_LONG, id_key, materialise, require

#: Probes of a splitter in one round, and the most of all splitters together.
PROBES, ALL_PROBES = 64, 1 << 18
#: Splitters are kept on the driver; up to so many.
MAX_SPLITTERS = 1 << 14


#: Rows are ordered by these: the key, a hash of the text, a row number.
ORDER = ("__key", "__hash", "__rid")


@dataclasses.dataclass
class Splitter:
    """A boundary in ``ORDER``: the rows beyond it have the ``prefix`` and are at
    ``low`` or more in the next column, or come later by an earlier column.
    While it is open it lies in [low, high)."""

    target: int
    low: int
    high: int
    below: int  # bytes before ``low``
    prefix: tuple = ()
    done: bool = False

    def step(self, probes: int) -> int:
        return -(-(self.high - self.low) // probes)

    @property
    def place(self) -> tuple:
        return self.prefix, self.low, self.high

    @property
    def start(self) -> tuple:
        """The first place in ``ORDER`` beyond the boundary."""
        return (*self.prefix, self.low, MIN_LONG, MIN_LONG)[:len(ORDER)]


def _longs(values) -> Column:
    return F.lit(np.array(list(values), dtype=np.int64))


def _count_from(starts: list[tuple]) -> Column:
    """How many of ``starts``, places in ``ORDER`` in ascending order, lie at or before
    a row: bisection, so the expression has the same size for any number of them."""
    if not starts:
        return F.lit(0)
    n, tables = len(starts), [_longs(c) for c in zip(*starts, strict=True)]

    def step(pos: Column, width: Column) -> Column:
        at = F.least(pos + width, F.lit(n))
        reached = F.lit(True)
        for column, table in reversed(list(zip(ORDER, tables, strict=True))):
            value = F.element_at(table, at)
            reached = (value < F.col(column)) | ((value == F.col(column)) & reached)
        return F.when((pos + width <= n) & reached, pos + width).otherwise(pos)

    widths = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])
    return F.aggregate(widths, F.lit(0), step)


def _probe(slim: DataFrame, open_: list[Splitter], probes: int) -> dict:
    """Exact bytes of every probe bin of every open interval, in one pass with
    map-side combine.  Two open intervals are the same or have no row in common."""
    wide = lambda x: x.cast("decimal(38,0)")  # noqa: E731  a difference of two longs need not be a long
    first = {s.place: s for s in sorted(open_, key=lambda s: s.start)}
    places = list(first)
    of = lambda values: F.element_at(_longs(values), F.greatest("place", F.lit(1)))  # noqa: E731  of a row's interval
    level = of(len(p) for p, _, _ in places)
    inside = F.lit(True)
    for i, c in enumerate(ORDER[:-1]):  # the columns before the interval's own must be its prefix
        inside &= (level <= i) | (F.col(c) == of(s.start[i] for s in first.values()))
    low, last = of(low for _, low, _ in places), of(high - 1 for _, _, high in places)
    value = F.element_at(F.array(*ORDER), level.cast("int") + 1)
    # whole division: a quotient with decimals is rounded, and may come out a bin too high
    at = F.call_function("div", wide(value) - wide(low), wide(of(s.step(probes) for s in first.values()))).cast("int")
    # exploded, so that the bisection runs once a row and not for each use of its result
    place = F.explode(F.array(_count_from([s.start for s in first.values()]))).alias("place")
    rows = (slim.select("*", place).where((F.col("place") > 0) & inside & (value >= low) & (value <= last)).select("place", at.alias("bin"), value.alias("at"), "size")
            .groupBy("place", "bin").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.max("at").alias("last"))
            .collect())
    found = {p: [] for p in places}
    for r in sorted(rows, key=lambda r: r["bin"]):
        found[places[r["place"] - 1]].append(r)
    return found


def find_splitters(slim: DataFrame, count: int, total: int, tolerance: int = 0) -> list[Splitter]:
    """``count`` - 1 splitters that cut ``slim`` (the columns of ``ORDER`` and
    ``size``, all long) into parts of equal bytes.  A row that reaches over a
    target stays before the splitter; with a positive ``tolerance`` any boundary
    at most so many bytes short of its target will do.

    What comes to the driver is at most ``PROBES`` sums per splitter and round, and
    ``ALL_PROBES`` in all."""
    if count > MAX_SPLITTERS:
        raise ValueError(f"at most {MAX_SPLITTERS} parts")
    ends = slim.agg(*[f(c) for c in ORDER for f in (F.min, F.max)]).first()
    splitters = [Splitter(-(-total * i // count), ends[0], ends[1] + 1, 0) for i in range(1, count)]
    while open_ := [s for s in splitters if not s.done]:
        probes = min(PROBES, ALL_PROBES // len(open_))
        sums = _probe(slim, open_, probes)
        for s in open_:
            (_, low, high), step = s.place, s.step(probes)
            for b in sums[s.place]:
                if s.below + b["bytes"] >= s.target:
                    s.low, s.high = low + b["bin"] * step, min(high, low + (b["bin"] + 1) * step)
                    break
                s.below += b["bytes"]
            level = len(s.prefix)
            if s.target - s.below <= tolerance:
                s.done = True
            elif b["rows"] == 1:  # the one row that reaches over the target
                s.low, s.done = b["last"] + 1, True
            elif s.high - s.low == 1:
                s.prefix += (s.low,)
                s.low, s.high = ends[2 * level + 2], ends[2 * level + 3] + 1
    return splitters


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   range_bytes: int = 16 << 20, tolerance: int = 0) -> DataFrame:
    """``docs`` with the added columns ``size`` (UTF-8 bytes of the text plus 1;
    null counts as empty), ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless
    from 0 in each shard, in id order).  Input columns of these names are
    replaced.

    With no tolerance a row belongs to the shard in whose share of the bytes the
    row starts, so shards differ by one row's size at most.  Null ids come
    first; rows of one id follow a hash of their texts, equal rows a row number,
    so that even one id or one row repeated very often is cut between shards.
    More shards than rows leave shards empty; an empty table gives an empty
    result.

    A shard is cut into ranges of about ``range_bytes``, each sorted by one task,
    or somewhat larger ones where that took more than ``MAX_SPLITTERS`` in all
    (from 256 GB with the default)."""
    require(docs, [id_col, text_col])
    text = F.col(f"`{text_col}`")
    rest = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    # written once, as row numbers must be the same for the counts and the exchange
    rows = materialise(docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], id_key(f"`{id_col}`").alias("__key"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("__hash"), F.monotonically_increasing_id().alias("__rid"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size")), "sharding")
    slim = rows.select(*ORDER, "size")
    total = slim.agg(F.sum("size")).first()[0]
    ranges = max(1, min(MAX_SPLITTERS // shards, -(-(total or 0) // (shards * range_bytes))))
    splitters = find_splitters(slim, shards * ranges, total, tolerance) if total else []
    number = _count_from([s.start for s in splitters])
    counts = slim.groupBy(number.alias("r")).count().collect()  # a row per range
    n = {r["r"]: r["count"] for r in counts}
    before = [sum(n.get(r, 0) for r in range(g - g % ranges, g)) for g in range(shards * ranges)]
    order = W.partitionBy("__range").orderBy(*ORDER)
    slot = F.element_at(_longs(before), F.col("__range") + 1) + F.row_number().over(order) - 1
    return rows.withColumn("__range", number).repartitionById(shards * ranges, "__range").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], "size",
        F.floor(F.col("__range") / ranges).cast("int").alias("shard"), slot.cast("long").alias("slot"))
