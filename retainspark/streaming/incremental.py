"""Incremental scoring with Structured Streaming.

New raw-customer files are read as a stream, pushed through the same
stateless encode → feature → score → segment plan as the batch path, and
each micro-batch is merged into the keyed score table with the upsert sink.
The upsert is idempotent for a given batch (same key → same row), so a
micro-batch re-run after a failure leaves the same table: together with
the stream checkpoint this gives exactly-once results.

With an event time, a row's order is the time of its event and not that of its batch:
the watermark drops rows later than the delay allowed,
``dropDuplicatesWithinWatermark`` drops events delivered again (state for as long
as the delay, on the cluster), and the upsert keeps a key's newest event, so rows
may come late and in any order of batches.

Table-wide quantities (the high-value percentile) cannot be computed on a
stream; they are taken from the last batch snapshot and passed in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.encode import encode_customers
from ..functions.features import derive_features
from ..plans.retention import batch_scores
from ..sources.io import upsert

RAW_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()), T.StructField("gender", T.StringType()),
    T.StructField("senior_citizen", T.IntegerType()), T.StructField("partner", T.StringType()),
    T.StructField("dependents", T.StringType()), T.StructField("tenure", T.IntegerType()),
    T.StructField("phone_service", T.StringType()), T.StructField("multiple_lines", T.StringType()),
    T.StructField("internet_service", T.StringType()), T.StructField("online_security", T.StringType()),
    T.StructField("online_backup", T.StringType()), T.StructField("device_protection", T.StringType()),
    T.StructField("tech_support", T.StringType()), T.StructField("streaming_tv", T.StringType()),
    T.StructField("streaming_movies", T.StringType()), T.StructField("contract", T.StringType()),
    T.StructField("paperless_billing", T.StringType()), T.StructField("payment_method", T.StringType()),
    T.StructField("monthly_charges", T.DoubleType()), T.StructField("total_charges", T.StringType()),
    T.StructField("churn", T.StringType()),
])


def score_stream(raw: DataFrame, threshold=0.5, high_value_threshold=None, event_time: str | None = None) -> DataFrame:
    """Stateless scoring plan over a (streaming or batch) raw-customer frame;
    ``scored_at`` is the row's ``event_time``, or the batch's time without one."""
    feats = derive_features(encode_customers(raw, "etl", keep=[event_time] if event_time else []), "etl", with_high_value=False)
    if high_value_threshold is not None:
        feats = feats.withColumn("is_high_value",
                                 (F.col("clv_proxy") > F.lit(float(high_value_threshold))).cast("int"))
    return batch_scores(feats, threshold=threshold, scored_at=F.col(event_time) if event_time else F.current_timestamp())


def run_incremental_scoring(spark: SparkSession, source_dir: str, target_path: str,
                            checkpoint_location: str, threshold=0.5, available_now: bool = True,
                            processing_time: str | None = None, event_time: str | None = None,
                            delay: str = "1 day", files_per_batch: int | None = None):
    """Start the stream: parquet files arriving in ``source_dir`` → scores →
    ``foreachBatch`` upsert into ``target_path``.  With ``available_now`` it
    processes what is there and stops (returns after termination).

    ``event_time`` names a timestamp column of the files.  An event is a customer and
    a time: one delivered again is dropped, one more than ``delay`` older than the
    newest of the batches before is too late and dropped (a NULL time counts as too
    late), of the others the newest of a customer stays in the table; of different
    rows of one event the first to come counts."""
    schema = T.StructType([*RAW_SCHEMA.fields, *([T.StructField(event_time, T.TimestampType())] if event_time else [])])
    reader = spark.readStream.schema(schema)
    raw = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(source_dir)
    if event_time:
        raw = (raw.where(F.col(event_time).isNotNull()).withWatermark(event_time, delay)
               .dropDuplicatesWithinWatermark(["customer_id", event_time]))
    scores = score_stream(raw, threshold, event_time=event_time)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            upsert(batch, target_path, "user_id", "scored_at", newest=event_time is not None)

    w = (scores.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_location)
         .outputMode("update"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
