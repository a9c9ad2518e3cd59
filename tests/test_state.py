"""Keyed state in the state store: releases and rolling bands over many micro-batches, with a restart."""

import json
import os
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorwatch.operators import spc
from sensorwatch.plans.catalog import streams
from sensorwatch.streaming import jobs, state


@pytest.fixture(autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    state.use_state_store(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


SENT = "batch_id string, expected_rows long, row_no string, payload string, sent timestamp"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


class Topic:
    """A folder of JSON files; each send is one file, and each file one micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.sent = spark, Path(root), 0
        (self.root / "topic").mkdir()

    def send(self, minute, *rows):
        """rows: (batch, announced, row number)."""
        at = (START + timedelta(minutes=minute)).isoformat()
        lines = [json.dumps({"batch_id": b, "expected_rows": n, "row_no": str(r), "payload": f"{b}{r}", "sent": at}) for b, n, r in rows]
        path = self.root / f"topic/{self.sent:04d}.json"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.sent, 1_700_000_000 + self.sent))
        self.sent += 1

    def run(self):
        frames = self.spark.readStream.schema(SENT).option("maxFilesPerTrigger", 1).json(str(self.root / "topic"))
        released = state.release_batches(frames, "sent", "30 minutes")
        jobs.to_files(released, str(self.root / "out"), str(self.root / "checkpoint")).awaitTermination()
        rows = self.spark.read.schema(state.RELEASED).parquet(str(self.root / "out")).collect()
        return sorted((r["batch_id"], r["row_no"], r["complete"]) for r in rows)


def test_fifty_micro_batches_with_a_restart(spark, folder):
    """Batch k has three rows, sent in micro-batches k, k + 1 and k + 2, the second one twice; the run is stopped after half of them."""
    topic, wanted = Topic(spark, folder), []
    for k in range(25):
        topic.send(k, *[(f"b{j:02d}", 3, k - j) for j in range(max(0, k - 2), k + 1)], *([(f"b{k - 1:02d}", 3, 1)] if k else []))
    assert topic.run() == [(f"b{j:02d}", str(r), True) for j in range(23) for r in range(3)]
    for k in range(25, 50):
        topic.send(k, *[(f"b{j:02d}", 3, k - j) for j in range(k - 2, k + 1)], (f"b{k - 1:02d}", 3, 1))
    wanted = [(f"b{j:02d}", str(r), True) for j in range(48) for r in range(3)]
    assert topic.run() == wanted
    topic.send(200, ("late", 1, 0))
    topic.send(201, ("b00", 3, 0), ("late", 1, 0))
    found = topic.run()
    given_up = [("b48", "0", False), ("b48", "1", False), ("b49", "0", False)]
    assert sorted(found) == sorted([*wanted, ("late", "0", True), *given_up])
    assert {p.name for p in Path(folder).iterdir()} == {"topic", "out", "checkpoint"}


def test_replays_within_the_horizon_and_rows_beyond_it(spark, folder):
    topic = Topic(spark, folder)
    topic.send(0, ("a", 2, 1), ("a", 2, 1), ("a", 2, 1))
    assert topic.run() == []
    topic.send(1, ("a", 2, 2))
    assert topic.run() == [("a", "1", True), ("a", "2", True)]
    topic.send(20, ("a", 2, 1), ("a", 2, 2))
    topic.send(21, ("x", 1, 1))
    assert len(topic.run()) == 3
    topic.send(90, ("y", 1, 1))
    topic.send(91, ("a", 2, 1), ("a", 2, 2))
    topic.send(30, ("z", 1, 1))
    found = topic.run()
    assert found.count(("a", "1", True)) == 2 and ("y", "1", True) in found and "z" not in {f[0] for f in found}


class Held:
    """A state variable in memory, and the handle that makes them."""

    def __init__(self):
        self.values, self.made, self.timers = [], {}, []

    def getListState(self, name, schema):
        return self.made.setdefault(name, Held())

    getValueState = getListState

    def listTimers(self):
        return list(self.timers)

    def registerTimer(self, at):
        self.timers = [at]

    def deleteTimer(self, at):
        self.timers.remove(at)

    def exists(self):
        return bool(self.values)

    def appendList(self, values):
        self.values += values

    def put(self, values):
        self.values = list(values)

    update = put

    def get(self):
        return self.values

    def clear(self):
        self.values = []


def test_rows_are_held_in_blocks(spark):
    """25,000 rows are a few values of the list state, not one for each; repeats go, the first row of a number stays, and nulls stay nulls."""
    handle, release = Held(), state.BatchRelease("sent")
    release.init(handle)
    clock = type("Clock", (), {"getCurrentWatermarkInMs": lambda self: 0})()

    def send(numbers, payload):
        rows = [("b", 25_001, n, payload and f"{payload}{n}", pd.Timestamp(START)) for n in numbers]
        return list(release.handleInputRows(("b",), iter([pd.DataFrame(rows, columns=[*state.FRAME.fieldNames(), "sent"])]), clock))

    assert send([str(i) for i in range(25_000)], "first") == []
    blocks = handle.made["rows"].values
    assert len(blocks) == 3 and sum(len(block) for _, block in blocks) < 500_000
    assert send(["7", "8"], "second") == []
    assert handle.made["facts"].values[0] == 25_000
    found = pd.concat(send([None], None))
    assert len(found) == 25_001 and found["complete"].all() and not handle.made["rows"].values
    kept = dict(zip(found["row_no"], found["payload"]))
    assert kept["7"] == "first7" and kept[None] is None and len(kept) == 25_001


def test_pieces_of_a_stream_are_written_by_several_tasks(spark, folder):
    """One piece is one micro-batch, whatever its size: a piece with fewer rows than files, or without any, is made up for by empty files."""
    numbers = [*range(500), 2001, 3999]
    rows = spark.createDataFrame([(i,) for i in numbers], "n long")
    stream = streams._in_order(spark, rows, "n", f"{folder}/in", file_rows=40)
    files = spark.read.parquet(f"{folder}/in").inputFiles()
    assert len(files) == 16
    seen = {}
    note = lambda batch, number: seen.__setitem__(number, sorted(r["n"] for r in batch.collect()))
    stream.writeStream.foreachBatch(note).option("checkpointLocation", f"{folder}/kept").trigger(availableNow=True).start().awaitTermination()
    assert [seen[k] for k in sorted(seen) if seen[k]] == [list(range(500)), [2001], [3999]]


def write_file(frame, root, i):
    """Files are taken in the order of their times."""
    frame.to_json(f"{root}/in/{i:03d}.json", orient="records", lines=True)
    os.utime(f"{root}/in/{i:03d}.json", (1_700_000_000 + i, 1_700_000_000 + i))


def in_files(spark, frames, root):
    """One file for each frame, in order."""
    Path(root, "in").mkdir()
    for i, frame in enumerate(frames):
        write_file(frame, root, i)
    return lambda schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{root}/in")


def test_bands_of_the_stream_equal_those_of_the_batch(spark, folder):
    """Two features with gaps, one key with most rows, late rows and repeats, and a restart."""
    rows = [(i, "hot" if i % 3 else f"k{i % 5}", float(i * i % 97) if i % 11 else None, float(i % 13)) for i in range(400)]
    frame = pd.DataFrame(rows, columns=["seq", "k", "gap", "area"]).astype({"seq": "int64"})
    parts = [frame.iloc[i : i + 50].sample(frac=1, random_state=i) for i in range(0, 400, 50)]
    parts[3] = pd.concat([parts[3], parts[1].iloc[:7].assign(gap=1e6), parts[3].iloc[:5]])
    schema, stream = "seq long, k string, gap double, area double", None
    stream = in_files(spark, parts[:4], folder)
    for more in (parts[4:], []):
        bands = state.rolling_bands_stream(stream(schema), ["gap", "area"], ["k"], "seq")
        jobs.to_files(bands, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        for i, part in enumerate(more, 4):
            write_file(part, folder, i)
    found = spark.read.parquet(f"{folder}/out").orderBy("seq").toPandas()
    batch = spc.control_bands(spark.createDataFrame(rows, "seq long, k string, gap double, area double"), ["gap", "area"], ["k"], ["seq"])
    wanted = batch.select(*found.columns).orderBy("seq").toPandas()
    pd.testing.assert_frame_equal(found, wanted, rtol=1e-9, atol=1e-9)
    assert found["gap"].isna().sum() == wanted["gap"].isna().sum() > 30


def test_bands_by_timestamp(spark, folder):
    frame = pd.DataFrame({"k": ["a"] * 30, "at": [(START + timedelta(seconds=i)).isoformat() for i in range(30)], "v": [float(i % 4) for i in range(30)]})
    stream = in_files(spark, [frame.iloc[:12], frame.iloc[12:]], folder)("k string, at timestamp, v double")
    jobs.to_files(state.rolling_bands_stream(stream, ["v"], ["k"], "at", rows=4), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    last = spark.read.parquet(f"{folder}/out").orderBy(F.desc("at")).first()
    assert last["v_ma"] == pytest.approx(1.5) and last["v_std"] == pytest.approx(1.2909944487)
