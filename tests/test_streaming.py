"""Streams: the snapshot they keep is that of a batch run; redelivered batches change nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessaline.plans.store import SnapshotStore
from tessaline.streaming import incremental as I


def test_stream_makes_the_snapshot_of_a_batch(spark, tmp_path):
    landed = f"{tmp_path}/in"
    for part in ([("a", "1", 1), ("b", "1", 2)], [("a", "2", 3), ("a", "3", 5), ("c", "1", 4)], [("b", "1", 6)]):
        spark.createDataFrame(part, "key string, sha256 string, ord long").coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema("key string, sha256 string, ord long").option("maxFilesPerTrigger", 1).parquet(landed)
    store = SnapshotStore(spark, f"file://{tmp_path}/store")
    I.maintain(stream, store, f"{tmp_path}/check").awaitTermination()
    now = sorted((r["key"], r["sha256"]) for r in store.read().collect())
    assert now == [("a", "3"), ("b", "1"), ("c", "1")]
    version = store.current()
    I.merge_batch(store, spark.createDataFrame([("z", "9", 9)], "key string, sha256 string, ord long"), 0)
    assert store.current() == version


def test_transitions_with_state(spark, tmp_path):
    landed = f"{tmp_path}/in"
    for part in ([("a", "1", 1), ("b", "1", 2)], [("a", "1", 3), ("a", "2", 4)]):
        spark.createDataFrame(part, "key string, sha256 string, ord long").coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema("key string, sha256 string, ord long").parquet(landed)
    query = I.changes(stream).writeStream.format("memory").queryName("transitions").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r["key"], r["status"], r["sha256"]) for r in spark.table("transitions").collect())
    assert got == [("a", "added", "1"), ("a", "updated", "2"), ("b", "added", "1")]


def test_windows(spark, small, tmp_path):
    spark.read.parquet(f"{small}/events.parquet").write.parquet(f"{tmp_path}/e")
    stream = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string, value double, props string").parquet(f"{tmp_path}/e")
    query = I.windowed_counts(stream).writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("windows").agg(F.sum("n")).first()[0] == spark.read.parquet(f"{small}/events.parquet").count()
