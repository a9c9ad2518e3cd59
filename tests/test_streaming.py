import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorwatch.operators.forest import IsolationForest
from sensorwatch.operators.refine import refine
from sensorwatch.sources import files, messages
from sensorwatch.streaming import jobs


class Topic:
    """A folder of text files; each send is one file, and each file one micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.sent = spark, root, 0

    def send(self, batch_id, expected, row_numbers):
        self.sent += 1
        lines = [
            json.dumps({"batch_id": batch_id, "expected_rows": expected, "row_no": str(n), "payload": json.dumps({"n": n})}) for n in row_numbers
        ]
        self.spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(f"{self.root}/topic")

    def release(self):
        seen = []

        def release(rows, batch):
            seen.extend((r["batch_id"], r["row_no"]) for r in rows.collect())

        frames = messages.decode_frames(messages.read_stream(self.spark, {"maxFilesPerTrigger": "1"}, "text", f"{self.root}/topic"))
        jobs.FramedBatches(self.root, release).start(frames, f"{self.root}/checkpoint").awaitTermination()
        return sorted(seen)


def test_a_batch_is_released_when_complete(spark, folder):
    topic = Topic(spark, folder)
    topic.send("a", 3, [1, 2])
    assert topic.release() == []
    topic.send("a", 3, [2])
    assert topic.release() == []
    topic.send("b", 1, [1])
    assert topic.release() == [("b", "1")]
    topic.send("a", 3, [3])
    assert topic.release() == [("a", "1"), ("a", "2"), ("a", "3")]
    topic.send("a", 3, [1, 2, 3])
    assert topic.release() == []
    topic.send("c", 2, [1, 2])
    assert topic.release() == [("c", "1"), ("c", "2")]


def test_several_batches_in_one_run(spark, folder):
    topic = Topic(spark, folder)
    topic.send("a", 2, [1])
    topic.send("b", 2, [1, 2])
    topic.send("a", 2, [2])
    assert topic.release() == [("a", "1"), ("a", "2"), ("b", "1"), ("b", "2")]


def test_a_repeated_micro_batch_gives_the_same_release(spark, folder):
    seen = []
    framed = jobs.FramedBatches(folder, lambda rows, batch: seen.append((batch, rows.count())))
    frames = lambda *n: spark.createDataFrame([("a", 2, str(i), "{}") for i in n], messages.FRAME)
    framed(frames(1), 0)
    framed(frames(2), 1)
    framed(frames(2), 1)
    assert seen == [(1, 2), (1, 2)]
    framed(frames(1, 2), 2)
    assert len(seen) == 2


def stream_of(spark, rows, folder, files=3):
    rows.repartition(files).write.parquet(f"{folder}/in")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def run(stream, spark, folder, name="out"):
    jobs.to_files(stream, f"{folder}/{name}", f"{folder}/{name}-checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/{name}")


def test_refined_stream_equals_batch(spark, folder):
    rows = spark.range(60).select(
        F.col("id").alias("BatchID"), F.when(F.col("id") % 3 > 0, " Pass ").otherwise("Fail").alias("PASS_FAILED"), F.lit("01/02/2023").alias("Date"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 1.5).alias("DomeCaseGap"), (F.col("id") * 2.0).alias("StitchArea"), F.lit("01:30").alias("Test_Time_min"),
    )
    keep = ["batchid", "domecasegap", "stitcharea", "test_time_sec", "date"]
    live = run(jobs.refined_stream(stream_of(spark, rows, folder), keep=keep), spark, folder)
    batch = refine(rows, keep=keep)
    assert live.exceptAll(batch).count() == 0 and live.count() == batch.count() > 0


def test_scored_stream_equals_batch(spark, folder):
    rows = spark.range(300).select("id", (F.col("id") % 50).cast("double").alias("v"))
    model, labelled = IsolationForest(["v"], seed=2, trees=10).fit_score(rows, ["id"])
    live = run(jobs.scored_stream(stream_of(spark, rows, folder), model), spark, folder)
    assert live.exceptAll(labelled.select(*live.columns)).count() == 0 and live.count() == 300


EVENTS = [
    (1, datetime(2024, 1, 1, 5), 1.0), (2, datetime(2024, 1, 7, 23), 3.0), (3, datetime(2024, 1, 8, 0), 5.0), (1, datetime(2024, 1, 1, 5), 1.0),
]


def test_repeats_are_dropped_across_micro_batches(spark, folder):
    rows = spark.createDataFrame(EVENTS, "id int, ts timestamp_ntz, v double")
    live = run(jobs.first_arrivals(stream_of(spark, rows, folder, 4), ["id"], "ts", "30 days"), spark, folder)
    assert sorted(r["id"] for r in live.collect()) == [1, 2, 3]


def test_weekly_stream_starts_weeks_on_monday(spark, folder):
    rows = spark.createDataFrame(EVENTS[:3], "id int, ts timestamp_ntz, v double")
    weekly = jobs.weekly_stream(stream_of(spark, rows, folder), "ts", "v", "30 days")
    for _ in range(2):  # the second run finds nothing new and changes nothing
        jobs.keep_latest(weekly, ["week_start"], f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        found = jobs.read_latest(spark, f"{folder}/out", weekly.schema, ["week_start"])
        assert sorted((r["week_start"], r["rows"], r["mean"]) for r in found.collect()) == [(datetime(2024, 1, 1), 2, 2.0), (datetime(2024, 1, 8), 1, 5.0)]


def test_alert_stream(spark, folder):
    rows = spark.createDataFrame([(1, "a", 5.0), (2, "a", 99.0), (3, "b", 0.5)], "id int, k string, v double")
    limits = spark.createDataFrame([("a", 1.0, 50.0), ("b", 1.0, 50.0)], "k string, lo_limit double, hi_limit double")
    live = run(jobs.alert_stream(stream_of(spark, rows, folder), limits, ["k"], "v"), spark, folder)
    assert {r["id"]: r["zone"] for r in live.collect()} == {2: "above", 3: "below"}


def test_live_trigger_runs(spark, folder):
    spark.range(20).write.parquet(f"{folder}/in")
    live = jobs.to_files(spark.readStream.schema("id long").parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/checkpoint", jobs.LIVE)
    try:
        live.processAllAvailable()
        assert spark.read.parquet(f"{folder}/out").count() == 20
    finally:
        live.stop()


def test_framing_keeps_no_more_than_is_open(spark, folder):
    """Each micro-batch completes the batch begun in the one before; folders do not pile up."""
    done = []
    framed = jobs.FramedBatches(folder, lambda rows, n: done.append((n, rows.count())), replay=3)
    frame = lambda k, part: (f"b{k}", 2, str(part), "{}")
    for k in range(12):
        rows = [frame(k, 0)] + ([frame(k - 1, 1)] if k else [])
        framed(spark.createDataFrame(rows, "batch_id string, expected_rows long, row_no string, payload string").coalesce(1), k)
        assert len(files.numbered(spark, f"{folder}/arrived", "epoch")) <= 3
        assert len(files.numbered(spark, f"{folder}/open", "epoch")) <= 2 and len(files.numbered(spark, f"{folder}/released", "epoch")) <= 4
    assert done == [(k, 2) for k in range(1, 12)]


def test_updates_are_folded(spark, folder):
    for k in range(3):
        spark.createDataFrame([(1, k), (10 + k, k)], "id long, v long").write.parquet(f"{folder}/u/batch={k}")
    schema = spark.createDataFrame([], "id long, v long").schema
    jobs.fold_updates(spark, f"{folder}/u", schema, ["id"])
    assert files.numbered(spark, f"{folder}/u", "batch") == [2]
    assert sorted(map(tuple, jobs.read_latest(spark, f"{folder}/u", schema, ["id"]).collect())) == [(1, 2), (10, 0), (11, 1), (12, 2)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_event_time_is_zoned(spark, kind):
    rows = spark.createDataFrame([(datetime(2024, 1, 1),)], f"ts {kind}")
    assert jobs.event_time(rows, "ts").schema["ts"].dataType.typeName() == "timestamp"
