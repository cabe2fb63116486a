"""Sources and sinks.

Keyed tables are Parquet partitioned by a hash of the key.  A write reads only the
buckets that the batch touches, unions them with the batch under a side tag,
reduces per key with ``max_by`` / ``min_by`` (partial aggregation, so a key repeated
in a third of the batch is combined map-side) and replaces these buckets by
Spark's dynamic partition overwrite: what is read and written follows the batch.
All working folders live under the shared checkpoint directory.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, stable

#: Partition columns of a keyed table: the number of its buckets and a row's.
BUCKETS, BUCKET = "__buckets", "__bucket"


def join_path(*parts: str) -> str:
    """Join path segments of any filesystem URI (hdfs://, s3a://, file:)."""
    return "/".join([parts[0].rstrip("/")] + [p.strip("/") for p in parts[1:]])


def work_dir(spark: SparkSession, name: str = "tables") -> str:
    """A fresh folder under the shared checkpoint directory."""
    return join_path(checkpoint_dir(spark), name, uuid.uuid4().hex)


# ------------------------------------------------------------------ S1 / S5


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and an explicit schema (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> str:
    """Overwrite sink."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


# ------------------------------------------------------------------ S3 / S4


def require_rows(df: DataFrame) -> bool:
    """False when the input has no rows (reads at most one row)."""
    return not df.isEmpty()


def coalesce_source(primary, fallback):
    """S3: the primary source when it can be read and has rows, else the
    fallback; ``None`` when neither has data.  Sources are zero-argument
    callables returning DataFrames."""
    for src in (primary, fallback):
        try:
            df = src()
        except (AnalysisException, FileNotFoundError, OSError):
            continue
        if df is not None and require_rows(df):
            return df
    return None


# ------------------------------------------------------------------ keyed tables


def _stored(spark: SparkSession, path: str):
    """The keyed table with its partition columns, ``None`` when absent."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None):
    """A keyed table; when absent ``None``, or no rows if ``schema`` is given."""
    table = _stored(spark, path)
    if table is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return table.drop(BUCKETS, BUCKET)


def _replace_buckets(incoming: DataFrame, path: str, key: str, buckets: int, merge) -> DataFrame:
    """Replace each bucket that has rows in ``incoming`` by ``merge`` of its stored
    rows (or ``None``) and the incoming ones.

    A table keeps the number of buckets of its first write.  The merged rows
    are checkpointed before the first file is replaced, and Spark moves finished files
    into place at the end of the job, so a failed task or job leaves the table as
    it was and may be repeated; only a driver lost while it moves them leaves some
    buckets new and others old, which the repeated write sets right."""
    spark = incoming.sparkSession
    table = _stored(spark, path)
    first = table.select(BUCKETS).head() if table is not None else None
    n = first[0] if first else buckets
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("int")
    new = stable(incoming.withColumn(BUCKET, bucket))
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most n numbers
    if touched:
        old = table.where(F.col(BUCKET).isin(touched)).drop(BUCKETS, BUCKET) if first else None
        out = stable(merge(old, new.drop(BUCKET)))
        (out.withColumns({BUCKETS: F.lit(n), BUCKET: bucket}).hint("rebalance", F.col(BUCKET))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKETS, BUCKET).parquet(path))
    elif table is None:
        return merge(None, new.drop(BUCKET))
    return read_current(spark, path)


# ------------------------------------------------------------------ S6 / S7


def _tie(df: DataFrame, columns) -> Column:
    """A hash of the row's other cells: rows of one key and order value are told
    apart by content, never by where they happen to lie."""
    return F.xxhash64(*[F.col(c).cast("string") for c in sorted(columns)])


def upsert(incoming: DataFrame, path: str, key: str, order_col: str,
           created_col: str = "created_at", now=None, buckets: int = 16, newest: bool = False) -> DataFrame:
    """Insert new keys; for existing keys replace every column except
    ``created_col`` (which keeps its first value); within the batch the row
    with the greatest ``order_col`` wins, of equal ones the one with the greatest
    hash of its cells.  With ``newest`` a stored row with a greater ``order_col``
    stays, so batches may come late.  Returns the table.

    ``buckets`` counts for a table's first write; choose it so that a bucket is some
    hundred MB.  Equal batches leave equal tables."""
    now = now if now is not None else F.current_timestamp()
    payload = [c for c in incoming.columns if c not in (key, created_col)]
    cols = [*payload, created_col]
    # no order beyond these: of equal rows it does not matter which one is taken
    rank = ("__ord", "__side", "__tie") if newest else ("__side", "__ord", "__tie")

    def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
        side = lambda df, n: df.select(key, *cols, F.lit(n).alias("__side"), F.col(order_col).alias("__ord"),
                                       _tie(df, payload).alias("__tie"))
        rows = side(new, 1) if old is None else side(old, 0).unionByName(side(new, 1))
        merged = rows.groupBy(key).agg(F.max_by(F.struct(*payload), F.struct(*rank)).alias("__row"),
                                       F.min_by(F.col(created_col), F.struct("__side", "__ord", "__tie")).alias(created_col))
        return merged.select(key, *[F.col("__row")[c].alias(c) for c in payload], created_col)

    return _replace_buckets(incoming.select(key, *payload, now.alias(created_col)), path, key, buckets, merge)


def insert_ignore(incoming: DataFrame, path: str, key: str, order_col: str,
                  id_format: str = "CUST_%05d", buckets: int = 16) -> DataFrame:
    """Keys already present are left alone, the first incoming row of a
    new key is inserted; a missing key becomes ``id_format`` of the row's
    position in the order of ``order_col`` and a hash of its cells.  Positions are
    only computed if a key is missing.  Returns the table; ``buckets`` as in
    ``upsert``."""
    from ..operators.ranking import global_running_sum
    cols = [c for c in incoming.columns if c != key]
    inc = incoming.withColumn("__tie", _tie(incoming, cols))
    if not inc.where(F.col(key).isNull()).isEmpty():
        inc = global_running_sum(inc, [F.asc(order_col), F.asc("__tie"), F.asc(key)], {"__pos": F.lit(1)}, exclusive=True)
        inc = inc.withColumn(key, F.coalesce(F.col(key), F.format_string(id_format, F.col("__pos"))))

    def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
        side = lambda df, n: df.select(key, *cols, F.lit(n).alias("__side"), F.col(order_col).alias("__ord"),
                                       _tie(df, cols).alias("__tie"))
        rows = side(new, 1) if old is None else side(old, 0).unionByName(side(new, 1))
        merged = rows.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct("__side", "__ord", "__tie")).alias("__row"))
        return merged.select(key, *[F.col("__row")[c].alias(c) for c in cols])

    return _replace_buckets(inc.select(key, *cols), path, key, buckets, merge)


# ------------------------------------------------------------------ S8 / S9 / S10


def append_log(df: DataFrame, path: str, ts_col: str = "executed_at") -> None:
    """Append rows stamped with the write time, partitioned by day."""
    (df.withColumn(ts_col, F.current_timestamp())
       .withColumn("log_date", F.to_date(ts_col))
       .write.mode("append").partitionBy("log_date").parquet(path))


def write_summary(df: DataFrame, path: str) -> None:
    """One-record JSON summary, replaced on every write."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_summary(spark: SparkSession, path: str, schema: T.StructType | str | None = None):
    try:
        r = spark.read.schema(schema).json(path) if schema else spark.read.json(path)
        return r
    except AnalysisException:
        return None


def create_if_absent(spark: SparkSession, name: str, ddl_columns: str, path: str) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over a parquet location."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING parquet LOCATION '{path}'")


# ------------------------------------------------------------------ S12


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive table fingerprint: row count, the 128-bit sum and the
    XOR of a 64-bit row hash (all partial aggregates)."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(h.cast(T.DecimalType(38, 0))).cast("string").alias("hash_sum"),
                  F.bit_xor(h).alias("hash_xor"))


FINGERPRINT_SCHEMA = "rows long, hash_sum string, hash_xor long"


def record_fingerprint(df: DataFrame, path: str) -> dict:
    """Store the fingerprint as a one-record JSON table at ``path``."""
    fp = fingerprint(df)
    write_summary(fp, path)
    return read_summary(df.sparkSession, path, FINGERPRINT_SCHEMA).first().asDict()


def validate_fingerprint(df: DataFrame, path: str) -> bool:
    """No record → pass; a record without a hash → error; a different
    fingerprint → error (the data changed since it was recorded)."""
    rec = read_summary(df.sparkSession, path, FINGERPRINT_SCHEMA)
    rec = rec.first() if rec is not None else None
    if rec is None:
        return True
    if not rec["hash_sum"]:
        raise ValueError("fingerprint record has no hash")
    cur = fingerprint(df).first()
    if (cur["rows"], cur["hash_sum"], cur["hash_xor"]) != (rec["rows"], rec["hash_sum"], rec["hash_xor"]):
        raise ValueError(f"data fingerprint mismatch: expected {rec.asDict()}, found {cur.asDict()}")
    return True
