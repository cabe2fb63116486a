"""Benchmark decontamination with a broadcast hash set of test n-grams.

Normalised words (A-Z lower-cased; maximal runs of a-z, 0-9 and anything beyond
ASCII) of every item make windows of ``n`` consecutive words; an item of fewer
words is one window.  The distinct window hashes are the set that is broadcast.
A document's words are hashed once; the hashes of longer windows come from those of two
shorter ones, so a scan copies no word.  Where a hash is in the set, the
window's words are fetched and verified one by one.  Everything runs on DataFrame
functions.

Only hashes are broadcast, and only after they were counted: at most
``BROADCAST_WINDOWS`` at a time (8 bytes each and the map around them).  A larger
benchmark takes several scans of that many hashes; nothing else changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retainspark.llm.common import id_key, require
from retainspark.session import stable

BROADCAST_WINDOWS = 2_000_000
#: Occurrences in one document that are verified together.
CHUNK = 1 << 14
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(text: Column) -> Column:
    """A-Z in lower case, other letters untouched.  ``lower`` does that to pure
    ASCII faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def normal_words(text: Column) -> Column:
    """Words of a text; null and wordless texts give an empty array."""
    return F.filter(F.split(normalised(F.coalesce(text, F.lit(""))), NO_WORD), lambda w: w != "")


def _windows(words: Column, size: int) -> Column:
    """All windows of ``size`` words in order, as (start, words).  Single cells
    are read, as ``slice`` copies the whole array each time."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size))
    return F.coalesce(F.transform(starts, lambda i: F.struct(
        i.alias("start"), F.array(*[words[i + k] for k in range(size)]).alias("words"))), F.array())


def benchmark_windows(benchmark: DataFrame, n: int = 10, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """``(item, hash, words)``: the distinct windows of every item."""
    items = require(benchmark, [id_col, text_col]).select(
        F.col(f"`{id_col}`").alias("item"), normal_words(F.col(f"`{text_col}`")).alias("w")).filter("size(w) > 0")
    grams = F.when(F.size("w") < n, F.array("w")).otherwise(F.transform(_windows(F.col("w"), n), lambda x: x["words"]))
    return (items.select("item", F.explode(grams).alias("words")).distinct()
            .select("item", "words"))


def _pairs(a: Column, b: Column, shift: int) -> Column:
    """Hashes of a window at i and the window at i + ``shift`` behind it (no use at the end)."""
    return F.zip_with(a, F.slice(b, shift + 1, F.greatest(F.size(b) - shift, F.lit(0))), lambda x, y: F.xxhash64(x, y))


def _window_hashes(words: Column, size: int) -> Column:
    """A hash per window of ``size`` words, in order.  Windows of 1, 2, 4, ... words are
    made from two halves each, and joined as the size's binary digits say."""
    def grow(power: Column, width: int, done: Column | None, covered: int) -> Column:
        if size & width:
            first = done is None
            done, covered = power if first else _pairs(done, power, covered), covered + width
        if covered == size:
            return F.slice(done, 1, F.greatest(F.size(words) - size + 1, F.lit(0)))
        # arrays that are used twice are bound as a variable, so that they are made once
        own = covered and not first if size & width else done is not None
        held = F.array(F.struct(power.alias("p"), *([done.alias("d")] if own else [])))
        return F.flatten(F.transform(held, lambda v: grow(
            _pairs(v["p"], v["p"], width), 2 * width, v["d"] if own else v["p"] if covered else None, covered)))

    return grow(F.transform(words, lambda w: F.xxhash64(w)), 1, None, 0)


def candidates(docs: DataFrame, windows: DataFrame, sizes: list[int], count: int) -> DataFrame:
    """``(__id, __tie, size, start)`` where a window's hash is one of the benchmark's; ``docs`` has
    ``__id``, ``__tie`` and ``__text``."""
    keys = windows.select("hash").distinct()
    scans = -(-count // BROADCAST_WINDOWS)
    out = None
    for size in sizes:
        # the words are a bound variable, so that the text is split once; an outer explode, as a
        # plain one also computes the windows to filter on their number
        hashes = F.flatten(F.transform(F.array(normal_words(F.col("__text"))), lambda w: _window_hashes(w, size)))
        scanned = docs.select("__id", "__tie", F.posexplode_outer(hashes).alias("start", "hash"))
        for k in range(scans):
            part = keys if scans == 1 else keys.filter(F.pmod("hash", F.lit(scans)) == k)
            found = scanned.join(F.broadcast(part), "hash").select("__id", "__tie", F.lit(size).alias("size"), "start")
            out = found if out is None else out.unionByName(found)
    return out


def hits(docs: DataFrame, windows: DataFrame, sizes: list[int], count: int) -> DataFrame:
    """``(__id, __tie, start, words)`` of every verified occurrence; ``docs`` has
    ``__id``, ``__tie`` and ``__text``."""
    found = stable(candidates(docs, windows, sizes, count).distinct())
    chunk = F.floor(F.col("start") / CHUNK)
    starts = found.groupBy("__id", "__tie", "size", chunk.alias("chunk")).agg(F.collect_list("start").alias("starts"))
    # single cells are read, as ``slice`` copies the whole array each time
    cut = F.flatten(F.transform(F.array(normal_words(F.col("__text"))), lambda w: F.transform("starts", lambda i: F.struct(
        i.alias("start"), F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda k: F.get(w, i + k)).alias("words")))))
    occurring = (docs.join(starts, ["__id", "__tie"]).select("__id", "__tie", F.explode(cut).alias("o"))
                 .select("__id", "__tie", "o.start", "o.words").distinct())
    tests = windows.select("words").distinct()
    return occurring.join(tests, "words").select("__id", "__tie", "start", "words")


def _keys(id_col: str, text_col: str) -> list[Column]:
    """A row's key: its id and a hash of its text."""
    return [id_key(f"`{id_col}`").alias("__id"),
            F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("__tie")]


def _found(docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str, item_col: str,
           item_text_col: str) -> tuple[DataFrame, DataFrame]:
    """The benchmark's windows and where they occur."""
    windows = stable(benchmark_windows(benchmark, n, item_col, item_text_col))
    size = windows.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set(F.size("words"))).alias("sizes")).first()
    slim = docs.select(*_keys(id_col, text_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    if size["n"]:
        own = F.coalesce(*[F.when(F.size("words") == s, F.element_at(_window_hashes(F.col("words"), s), 1)) for s in size["sizes"]])
        return windows, stable(hits(slim, windows.withColumn("hash", own), size["sizes"], size["n"]))
    return windows, slim.limit(0).select("__id", "__tie", F.lit(0).alias("start"), F.array(F.lit("")).alias("words"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       ) -> DataFrame:
    """``docs`` with the added columns ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``spans`` (maximal intervals of them, word positions
    [start, end)), ``items`` (sorted strings: items with an occurring window) and
    ``contaminated``.  Input columns of these names are replaced.

    Null and wordless texts have no word and no hit, wordless items no window;
    a null item id counts as the string ``null``.  Rows of equal id and text are
    found separately and get the same result; rows of one id and different texts
    do not mix.  Empty tables give no hit or no row."""
    require(docs, [id_col, text_col])
    added = ["n_words", "n_hit", "spans", "items", "contaminated"]
    rest = [c for c in docs.columns if c not in added]
    full = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], *_keys(id_col, text_col),
                       F.size(normal_words(F.col(f"`{text_col}`"))).cast("long").alias("n_words"))
    windows, found = _found(docs, benchmark, n, id_col, text_col, item_col, item_text_col)
    keys = ["__id", "__tie"]
    spans = (found.select(*keys, "start", (F.col("start") + F.size("words")).alias("end")).distinct()
             .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("s"))
             .select(*keys, _merged(F.col("s")).alias("spans")))
    items = (found.select(*keys, "words").distinct().join(windows.select("item", "words"), "words")
             .select(*keys, F.coalesce(F.col("item").cast("string"), F.lit("null")).alias("item"))
             .groupBy(*keys).agg(F.sort_array(F.collect_set("item")).alias("items")))
    out = full.join(spans.join(items, keys), keys, "left")
    none = F.array().cast("array<struct<start: int, end: int>>")
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (out.withColumn("spans", F.coalesce("spans", none))
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], "n_words",
                    covered.alias("n_hit"), "spans",
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    (covered > 0).alias("contaminated")))


def _merged(spans: Column) -> Column:
    """Sorted intervals merged where they meet."""
    none = F.array().cast("array<struct<start: int, end: int>>")

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
                          F.concat(done, F.array(s)))

    return F.aggregate(spans, none, step)


def clean_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a window, columns unchanged.
    Special cases as in ``find_contamination``."""
    require(docs, [id_col, text_col])
    _, found = _found(docs, benchmark, n, id_col, text_col, item_col, item_text_col)
    keys = ["__id", "__tie"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_keys(id_col, text_col))
    return rows.join(found.select(*keys).distinct(), keys, "left_anti").select("row.*")
