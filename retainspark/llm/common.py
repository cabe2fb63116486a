"""Helpers shared by the training-data operators.

Words are maximal runs of anything but the six ASCII blanks (space, TAB, LF,
VT, FF, CR).  On UTF-8 bytes that is exactly ``bytes.split()``, so operators
that run Python read texts as binary and never decode them for splitting.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retainspark.session import checkpoint_dir

BLANKS = b" \t\n\r\x0b\x0c"
MIN_LONG = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the checkpoint directory, which every executor of
    the cluster can see."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage
    ends there, so a lost executor costs a re-read and no recomputation."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(text: str = "text") -> Column:
    """The text's UTF-8 bytes; Python then sees them without decoding."""
    return F.col(text).cast("binary")


def binary_values(column: pa.Array) -> list[bytes]:
    """Cells of a binary column, null as empty."""
    return [b"" if x is None else x for x in column.to_pylist()]


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose binary ``column`` holds about
    ``most`` bytes (one row at least), so memory doesn't follow the batch size."""
    for b in batches:
        ends = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0)).astype(np.int64).cumsum()
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def id_key(column: str) -> Column:
    """``column`` as a join key that is never null; a null id counts as the
    smallest one."""
    return F.coalesce(F.col(column).cast("long"), F.lit(MIN_LONG))


def hex16(column: Column) -> Column:
    """Sixteen lowercase hex digits of a long read as unsigned."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only the named columns: extra ones, whatever their names, stay out of
    the operator."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`") for c in columns])
