"""Keyed tables by buckets and the event-time stream."""
import datetime as dt
import os

from pyspark.sql import functions as F

from retainspark.sources import io as IO
from retainspark.streaming.incremental import run_incremental_scoring, score_stream


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("o"), F.lit(0.0).alias("v"))
    IO.upsert(base, path, "k", "o", now=F.lit(1), buckets=8)
    before = files(path)
    batch = base.where("k IN ('7', '8')").withColumn("v", F.lit(5.0)).withColumn("o", F.lit(2))
    # a table keeps the number of buckets of its first write
    out = IO.upsert(batch.unionByName(batch), path, "k", "o", now=F.lit(2), buckets=3)
    assert out.count() == 400 and out.where("v = 5").count() == 2 and out.where("created_at <> 1").count() == 0
    assert len(before - files(path)) <= 2
    kept = files(path)
    assert IO.upsert(base.limit(0), path, "k", "o", now=F.lit(3)).count() == 400 and files(path) == kept


def test_a_late_batch_does_not_replace_newer_rows(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, o int, v string")
    for newest, want in ((True, {"a": "new", "b": "x", None: "n"}), (False, {"a": "old", "b": "x", None: "n"})):
        path = str(tmp_path / f"t{newest}")
        IO.upsert(rows(("a", 5, "new"), (None, 1, "n")), path, "k", "o", now=F.lit(1), newest=newest)
        out = IO.upsert(rows(("a", 3, "old"), ("b", 1, "x")), path, "k", "o", now=F.lit(2), newest=newest)
        assert {r.k: r.v for r in out.collect()} == want


def test_empty_first_batch_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "k string, o int")
    assert IO.upsert(empty, path, "k", "o").count() == 0 and IO.read_current(spark, path) is None
    assert IO.insert_ignore(empty, path, "k", "o").count() == 0


def test_late_and_repeated_events_equal_the_batch(spark, tmp_path, sf_dir):
    from retainspark.sources.bridge import customers_raw
    raw = customers_raw(spark, sf_dir).orderBy("customer_id").limit(40)
    n = F.expr("CAST(substring(customer_id, 2) AS INT)")
    t0 = dt.datetime(2024, 1, 10)

    def drop(hours, where, tenure):
        return (raw.where(where).withColumn("tenure", F.lit(tenure))
                .withColumn("event_time", F.lit(t0).cast("timestamp") + F.expr(f"INTERVAL {hours} HOURS")))

    in_time = [drop(10, n % 2 == 0, 20), drop(4, F.lit(True), 10), drop(10, n % 2 == 0, 20)]  # late, then repeated
    too_late = drop(-72, F.lit(True), 70).withColumn("customer_id", F.concat(F.lit("L"), "customer_id"))
    src, tgt = str(tmp_path / "in"), str(tmp_path / "out")
    for i, d in enumerate([in_time[0], in_time[1], in_time[2].unionByName(too_late)]):
        d.coalesce(1).write.mode("append").parquet(src)
        newest = max(files(src), key=os.path.getmtime)
        os.utime(newest, (1_700_000_000 + 100 * i,) * 2)  # the order in which files are taken
    run_incremental_scoring(spark, src, tgt, str(tmp_path / "ck"), event_time="event_time", files_per_batch=1)
    got = IO.read_current(spark, tgt)
    every = in_time[0].unionByName(in_time[1])
    want = IO.upsert(score_stream(every, event_time="event_time"), str(tmp_path / "batch"), "user_id", "scored_at")
    cols = ["user_id", "churn_probability", "segment", "clv_proxy", "scored_at"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert got.count() == 40


def test_event_drops_are_written_by_all_tasks(spark, sf_dir, tmp_path, monkeypatch):
    # before, one task merged and wrote each drop
    from retainspark.plans import queries_io as Q
    monkeypatch.setattr(Q.IO, "work_dir", lambda *_: str(tmp_path))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = Q.streaming_events(spark, sf_dir)
        assert got.count() == got.select("user_id").distinct().count() == spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "incoming").glob("*.parquet"))) > 3
