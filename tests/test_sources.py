import json

import pytest
from pyspark.sql import functions as F

from sensorwatch.schemas import FEATURES, table
from sensorwatch.sources import files, messages

SCHEMA = table("year int, week int, v double")


def test_missing_table_reads_as_empty_or_raises(spark, folder):
    assert files.read_snapshot(spark, f"{folder}/none", SCHEMA).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_snapshot(spark, f"{folder}/none", SCHEMA, missing_ok=False)


def test_snapshot_replaces_and_append_adds(spark, folder):
    rows = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    path = f"{folder}/t"
    files.write_snapshot(rows((2022, 1, 1.0), (2023, 1, 2.0)), path, partition_by=["year"])
    files.write_snapshot(rows((2023, 2, 3.0)), path, partition_by=["year"])
    files.append_rows(rows((2023, 3, 4.0)), path, partition_by=["year"])
    assert sorted(tuple(r) for r in files.read_snapshot(spark, path, SCHEMA).select("year", "week", "v").collect()) == [(2023, 2, 3.0), (2023, 3, 4.0)]


def test_column_documents(spark, folder):
    for name, document in {
        "a": {"year": {"0": 2023, "1": 2023}, "week": {"0": 1, "1": 2}, "v": {"0": 1.5, "1": None}},
        "b": {"week": {"7": 9}, "v": {"7": 2.5}, "other": {"7": "x"}},
    }.items():
        with open(f"{folder}/{name}.json", "w") as out:
            json.dump(document, out)
    rows = files.read_column_documents(spark, folder, SCHEMA)
    assert sorted((r["source_index"], r["year"], r["week"], r["v"]) for r in rows.collect()) == [(0, 2023, 1, 1.5), (1, 2023, 2, None), (7, None, 9, 2.5)]


def test_station_files(spark, folder):
    for name, lines in {"SealingCell_57436U": "a,b\n1,2\n3,4\n", "SealingCell_2": "a,b\n", "Leak_Test_9": "a,b\n5,6\n"}.items():
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write(lines)
    rows = files.read_station_files(spark, f"{folder}/*.csv", table("a int, b int"))
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 2, "SealingCell", "57436U"), (3, 4, "SealingCell", "57436U"), (5, 6, "Leak_Test", "9")]
    assert sorted(tuple(r) for r in files.station_lots(rows).collect()) == [("Leak_Test", "9"), ("SealingCell", "57436U")]


def test_payload_names(spark):
    assert files.read_payload(spark.sql("select 'b', 1.0, 2.0, 'm', 3.0, 'x'")).columns[1:3] == FEATURES


def test_managed_table(spark, folder):
    spark.sql(f"create database if not exists store location '{folder}/store'")
    files.save_table(spark.createDataFrame([(2023, 1, 1.0)], SCHEMA), "store.weekly", ["year"])
    assert spark.table("store.weekly").count() == 1
    spark.sql("drop database store cascade")


def test_failed_connection_raises(spark):
    with pytest.raises(Exception):
        files.read_database(spark, "t", {"url": "jdbc:none://nowhere/db"})


def test_messages_keep_nulls_and_count(spark):
    rows = spark.createDataFrame([(1, None), (2, 3.0)], "id long, v double")
    sent = messages.to_messages(rows, "b1", ["id"])
    first = json.loads(sent.orderBy("value").first()["value"])
    assert first["expected_rows"] == 2 and "v" in json.loads(first["payload"])
    back = messages.decode_rows(messages.decode_frames(sent.union(spark.sql("select 'not json'"))), rows.schema)
    assert sorted((r["id"], r["v"], r["row_no"]) for r in back.collect()) == [(1, None, "1"), (2, 3.0, "2")]
    dropped = rows.select(messages.encode_rows(rows, keep_nulls=False).alias("x")).collect()
    assert '{"id":1}' in {r["x"] for r in dropped}


def test_messages_by_group(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, k string")
    frames = messages.decode_frames(messages.to_messages(rows, F.col("k"), ["id"], by=["k"]))
    assert {(r["batch_id"], r["expected_rows"]) for r in frames.collect()} == {("a", 2), ("b", 1)}
