"""Storage round trips and streaming queries. Each writes to its own folder under the shared scratch
folder and returns what it wrote; the streams run until their input is used up."""

import uuid
from datetime import date

from pyspark.sql import functions as F, types as T

from ...functions import text
from ...operators import alarms, spc
from ...operators.encode import CategoryCodes
from ...operators.forest import IsolationForest
from ...schemas import WEEKLY
from ...session import scratch_path, staged
from ...sources import files, messages
from ...sources.commits import PeriodTable
from ...sources.documents import read_column_documents_in_pieces
from ...sources.messages import FRAME
from ...streaming import jobs, state
from .. import jobs as daily
from . import bindings as b
from . import models
from .forest_twin import labelled_ctes
from .registry import query, rounded

_WEEK_KEYS = "CAST(year AS BIGINT) AS year, CAST(week AS BIGINT) AS week"


def _longs(df, *names):
    return df.withColumns({n: F.col(n).cast("long") for n in names})


@query(
    "S2_S3_S4_snapshot_and_append",
    f"WITH {b.WEEKLY} SELECT {_WEEK_KEYS}, maximum_domecasegap, CAST(CAST(stitcharea_week_mean AS FLOAT) AS DOUBLE) AS stitcharea_week_mean FROM weekly",
)
def snapshot_and_append(spark, folder):
    """A missing table reads as empty; a snapshot replaces it; an append adds to it by year."""
    path = scratch_path(spark, "weekly")
    weekly = b.weekly(spark, folder)
    stored = files.read_snapshot(spark, path, WEEKLY)
    first = weekly.filter("year <= 1998").unionByName(stored)
    files.write_snapshot(first, path, partition_by=["year"])
    files.append_rows(weekly.filter("year > 1998"), path, partition_by=["year"])
    rows = files.read_snapshot(spark, path, WEEKLY)
    return _longs(rows.select("year", "week", "maximum_domecasegap", rounded("stitcharea_week_mean").alias("stitcharea_week_mean")), "year", "week")


_DOCUMENTS = f"""WITH {b.WEEKLY} SELECT {_WEEK_KEYS}, maximum_domecasegap, CAST(CAST(stitcharea_week_mean AS FLOAT) AS DOUBLE) AS stitcharea_week_mean,
    CAST(CAST(domecasegap_week_stddev AS FLOAT) AS DOUBLE) AS domecasegap_week_stddev FROM weekly"""


def _written_documents(spark, folder):
    """The weekly history as one {column: {index: value}} document per year. A year has at most 54 weeks, so a document is small."""
    path = scratch_path(spark, "documents")
    names = WEEKLY.fieldNames()
    weekly = b.weekly(spark, folder).withColumn("folder", F.col("year"))
    cells = [F.map_from_entries(F.collect_list(F.struct(F.col("week").cast("string"), F.col(n).cast("string")))).alias(n) for n in names]
    documents = weekly.groupBy("folder").agg(*cells).select("folder", F.to_json(F.struct(*names)).alias("value"))
    documents.repartition("folder").write.partitionBy("folder").text(path)
    return f"{path}/*/*.txt"


def _shown_documents(rows):
    shown = rows.select("year", "week", "maximum_domecasegap", *[rounded(n).alias(n) for n in ("stitcharea_week_mean", "domecasegap_week_stddev")])
    return _longs(shown, "year", "week")


@query("S5_column_documents", _DOCUMENTS)
def column_documents(spark, folder):
    """Documents imported again, a file as one value."""
    return _shown_documents(files.read_column_documents(spark, _written_documents(spark, folder), WEEKLY))


@query("S5_column_documents_in_pieces", _DOCUMENTS)
def column_documents_in_pieces(spark, folder):
    """The same, read fragment by fragment, as a document of any size is."""
    return _shown_documents(read_column_documents_in_pieces(spark, _written_documents(spark, folder), WEEKLY))


@query(
    "S11_positional_names",
    "SELECT 'B' || l_suppkey AS blisterid, l_quantity AS domecasegap, l_extendedprice AS stitcharea, l_returnflag AS testtimemin, l_tax AS testtimesec, l_linestatus AS material FROM lineitem",
)
def positional_names(spark, folder):
    rows = b.table(spark, folder, "lineitem").select(
        F.concat(F.lit("B"), F.col("l_suppkey").cast("string")), "l_quantity", "l_extendedprice", "l_returnflag", "l_tax", "l_linestatus"
    )
    return files.read_payload(rows)


@query("S6_message_round_trip", "SELECT event_id, user_id, event_type, value, (SELECT count(*) FROM events) AS expected_rows FROM events")
def message_round_trip(spark, folder):
    rows = b.table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    path = scratch_path(spark, "messages")
    messages.publish(messages.to_messages(rows, "all", ["event_id"]), {}, "text", path)
    frames = messages.decode_frames(spark.read.text(path))
    return messages.decode_rows(frames, rows.schema).select("event_id", "user_id", "event_type", "value", "expected_rows")


@query(
    "S7_unreadable_messages",
    """SELECT CASE WHEN event_id % 3 = 0 THEN 'not json ' || event_id WHEN event_id % 3 = 1 THEN '{"batch_id":null,"row_no":"' || event_id || '"}'
    ELSE '{"batch_id":"x","row_no":"' || event_id || '","payload":"{broken"}' END AS value FROM events WHERE event_id % 5 = 0""",
)
def unreadable_messages(spark, folder):
    """Broken messages among good ones, as a quarantine receives them."""
    rows = b.table(spark, folder, "events").select("event_id", "value")
    number = F.col("event_id").cast("string")
    broken = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("not json "), number)).when(
        F.col("event_id") % 3 == 1, F.concat(F.lit('{"batch_id":null,"row_no":"'), number, F.lit('"}'))
    ).otherwise(F.concat(F.lit('{"batch_id":"x","row_no":"'), number, F.lit('","payload":"{broken"}')))
    bad = rows.filter("event_id % 5 = 0").select(broken.alias("value"))
    return messages.unreadable_messages(messages.to_messages(rows, "all", ["event_id"]).unionByName(bad))


@query("P16_required_columns", "SELECT count(*) AS rows, TRUE AS refused FROM events")
def required_columns(spark, folder):
    """A table that has the columns passes through; one that lacks a column is refused by name."""
    rows = b.table(spark, folder, "events")
    try:
        text.require_columns(rows, ["event_id", "weld_gap"])
        refused = False
    except ValueError as error:
        refused = "weld_gap" in str(error)
    return text.require_columns(rows, ["event_id", "value"]).agg(F.count(F.lit(1)).alias("rows"), F.lit(refused).alias("refused"))


def _event_stream(spark, folder):
    schema = b.table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


def _run(stream, label, spark):
    root = scratch_path(spark, label)
    jobs.to_files(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query(
    "S7_S8_T1_complete_batches",
    "SELECT strftime(ts, '%Y-%m-%d') AS batch_id, count(*) AS rows, sum(event_id) AS ids, CAST(CAST(sum(value) AS FLOAT) AS DOUBLE) AS total FROM events GROUP BY 1",
)
def complete_batches(spark, folder):
    """One message batch per day, spread over several files; each is released once, when complete."""
    root = scratch_path(spark, "framed")
    rows = b.table(spark, folder, "events").select("event_id", F.col("ts").cast("date").cast("string").alias("day"), "value")
    sent = messages.to_messages(rows, F.col("day"), ["event_id"], by=["day"])
    messages.publish(sent.repartition(3, "value"), {}, "text", f"{root}/topic")

    def release(batch, number):
        batch.write.mode("overwrite").parquet(f"{root}/released_rows/batch={number}")

    frames = messages.decode_frames(messages.read_stream(spark, {"maxFilesPerTrigger": "1"}, "text", f"{root}/topic"))
    jobs.FramedBatches(root, release).start(frames, f"{root}/checkpoint").awaitTermination()
    released = files.read_snapshot(spark, f"{root}/released_rows", FRAME)
    decoded = messages.decode_rows(released, rows.schema)
    return decoded.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"), rounded(F.sum("value")).alias("total")
    )


def _in_order(spark, rows, order, path, pieces=4, file_rows=1_000_000):
    """The rows in pieces that arrive one after the other, ranged by `order`; a stream over them takes one piece at a time.

    Large pieces are written by several tasks. Every piece has the same number of files; empty ones make up for those that a piece lacks.
    """
    low, high, count = rows.agg(F.min(order), F.max(order), F.count(order)).first()
    width, files = (high - low) // pieces + 1, max(1, -(-count // (pieces * file_rows)))
    for i in range(pieces):
        start = low + i * width
        piece = rows.filter((F.col(order) >= start) & (F.col(order) < start + width))
        (piece.coalesce(1) if files == 1 else piece.repartition(files, order)).write.mode("append").parquet(path)
        for _ in range((i + 1) * files - len(spark.read.schema(rows.schema).parquet(path).inputFiles())):
            rows.limit(0).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


@query(
    "T1_complete_batches_in_state",
    """SELECT strftime(ts, '%Y-%m-%d') AS batch_id, count(*) AS rows, sum(event_id) AS ids, CAST(CAST(sum(value) AS FLOAT) AS DOUBLE) AS total, TRUE AS complete FROM events
    WHERE day(ts) <> 15 GROUP BY 1""",
)
def complete_batches_in_state(spark, folder):
    """The same release from keyed state. Every row is sent twice; the batch of the 15th lacks a row, and so is never released."""
    root = scratch_path(spark, "state-batches")
    rows = b.table(spark, folder, "events").select("event_id", "ts", F.col("ts").cast("date").cast("string").alias("day"), "value")
    sent = messages.to_messages(rows.drop("ts"), F.col("day"), ["event_id"], by=["day"])
    frames = messages.decode_frames(sent).withColumn("event_id", F.col("row_no").cast("long"))
    framed = staged(frames.join(rows.select("event_id", F.col("ts").cast("timestamp").alias("sent")), "event_id"), "frames")
    first_of_15 = framed.filter("day(sent) = 15").agg(F.min("event_id")).scalar()
    kept = framed.filter(F.coalesce(F.col("event_id") != first_of_15, F.lit(True)))
    twice = kept.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    stream = _in_order(spark, staged(twice, "twice"), "event_id", f"{root}/topic").drop("event_id", "copy")
    state.use_state_store(spark)
    released = _run(state.release_batches(stream, "sent", "60 days"), "released", spark)
    decoded = messages.decode_rows(released, T.StructType([f for f in rows.schema.fields if f.name != "ts"]))
    return decoded.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"), rounded(F.sum("value")).alias("total"), F.bool_and("complete").alias("complete")
    )


@query(
    "T3_W1_W2_rolling_bands_stream",
    """SELECT event_id, user_id, value, CAST(CAST(avg(value) OVER w AS FLOAT) AS DOUBLE) AS ma, CAST(CAST(stddev_samp(value) OVER w AS FLOAT) AS DOUBLE) AS std,
    coalesce(abs(value - avg(value) OVER w) > 2 * stddev_samp(value) OVER w, FALSE) AS outside FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def rolling_bands_in_stream(spark, folder):
    """Mean, deviation and band of every arriving row over its key's last ten, from keyed state; the last file is sent again at the end."""
    path = scratch_path(spark, "bands-in")
    rows = b.table(spark, folder, "events").select("event_id", "user_id", "value")
    stream = _in_order(spark, rows, "event_id", path)
    rows.filter(F.col("event_id") > rows.agg(F.max("event_id") - 100).scalar()).coalesce(1).write.mode("append").parquet(path)
    state.use_state_store(spark)
    bands = _run(state.rolling_bands_stream(stream, ["value"], ["user_id"], "event_id"), "bands", spark)
    outside = F.abs(F.col("value") - F.col("value_ma")) > 2 * F.col("value_std")
    return bands.select(
        "event_id", "user_id", "value", rounded("value_ma").alias("ma"), rounded("value_std").alias("std"), F.coalesce(outside, F.lit(False)).alias("outside")
    )


@query(
    "T2_refined_stream",
    f"""WITH {b.REFINED} SELECT batchid, domecasegap, stitcharea, CAST(test_time_sec AS BIGINT) AS test_time_sec, strftime(day, '%Y-%m-%d') AS date,
    CAST(dense_rank() OVER (ORDER BY lotnumber) - 1 AS BIGINT) AS lotnumber FROM refined""",
)
def refined_stream(spark, folder):
    """The clean-up on a stream of line items, with stored category codes."""
    codes = CategoryCodes.fit(b.refined(spark, folder), ["lotnumber"])
    items = b.table(spark, folder, "lineitem")
    live = spark.readStream.schema(items.schema).option("pathGlobFilter", "lineitem.parquet").parquet(folder)
    fixed = b.table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.concat(F.lit(" "), "o_orderpriority").alias("lotnumber"))
    shown = live.join(fixed, "l_orderkey").select(
        F.col("l_orderkey").alias("BatchID"), F.when(F.col("l_linestatus") == "F", F.lit(" Pass\t")).otherwise(F.lit("Fail")).alias("PASS_FAILED"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("Date"), F.nullif("l_quantity", F.lit(13.0)).alias("DomeCaseGap"),
        F.col("l_extendedprice").alias("StitchArea"), "lotnumber",
        F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":"), F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")).alias("Test_Time_min"),
    )
    keep = ["batchid", "domecasegap", "stitcharea", "test_time_sec", "date", "lotnumber"]
    rows = _run(jobs.refined_stream(shown, codes, keep=keep), "refined", spark)
    return _longs(rows.withColumn("date", F.col("date").cast("string")), "test_time_sec", "lotnumber").select(*keep)


@query(
    "T3_alert_stream",
    """WITH r AS (SELECT event_id, user_id, value AS v, (user_id % 10) * 1.0 AS lo, 90.0 + user_id % 60 AS hi FROM events)
    SELECT event_id, v AS value, CASE WHEN v < lo THEN 'below' WHEN v > hi THEN 'above' ELSE 'near' END AS zone FROM r
    WHERE v < lo OR v > hi OR v <= lo + abs(lo) * 0.1 OR v >= hi - abs(hi) * 0.1""",
)
def alert_stream(spark, folder):
    users = b.table(spark, folder, "events").select("user_id").distinct()
    limits = users.select("user_id", (F.col("user_id") % 10).cast("double").alias("lo_limit"), (F.col("user_id") % 60 + 90).cast("double").alias("hi_limit"))
    alerts = jobs.alert_stream(_event_stream(spark, folder), limits, ["user_id"], "value").select("event_id", "value", "zone")
    return _run(alerts, "alerts", spark)


@query(
    "T3_alert_stream_salted",
    """WITH r AS (SELECT event_id, user_id, value AS v, (user_id % 10) * 1.0 AS lo, 90.0 + user_id % 60 AS hi FROM events)
    SELECT event_id, v AS value, CASE WHEN v < lo THEN 'below' WHEN v > hi THEN 'above' ELSE 'near' END AS zone FROM r
    WHERE v < lo OR v > hi OR v <= lo + abs(lo) * 0.1 OR v >= hi - abs(hi) * 0.1""",
)
def alert_stream_salted(spark, folder):
    """The same with limits joined by shuffle and the rows of each key spread over four tasks."""
    users = b.table(spark, folder, "events").select("user_id").distinct()
    limits = users.select("user_id", (F.col("user_id") % 10).cast("double").alias("lo_limit"), (F.col("user_id") % 60 + 90).cast("double").alias("hi_limit"))
    alerts = jobs.alert_stream(_event_stream(spark, folder), limits.hint("shuffle_merge"), ["user_id"], "value", salts=4)
    return _run(alerts.select("event_id", "value", "zone"), "alerts", spark)


@query("T7_live_cadence", "SELECT event_type, count(*) AS rows, '15 seconds' AS cadence FROM events GROUP BY event_type")
def live_cadence(spark, folder):
    """A live stream with its standing trigger: the rows at hand are written by the first micro-batch, and the query waits for the next one until it is stopped."""
    root, live = scratch_path(spark, "live"), _event_stream(spark, folder).select("event_id", "event_type")
    running = jobs.to_files(live, f"{root}/out", f"{root}/checkpoint", jobs.LIVE)
    running.processAllAvailable()
    waits = running.isActive
    running.stop()
    rows = spark.read.schema(live.schema).parquet(f"{root}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
    return rows.withColumn("cadence", F.lit(jobs.LIVE["processingTime"] if waits else "ended"))


@query(
    "S10_station_files",
    """SELECT 'Cell_' || l_returnflag AS station, l_linestatus AS lot, l_orderkey, l_linenumber, l_quantity FROM lineitem""",
)
def station_files(spark, folder):
    """One CSV file for each station and lot, named after them, scanned as one table."""
    root = scratch_path(spark, "stations")
    rows = staged(b.table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_quantity"), "rows")
    place = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    system = place(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for flag, status in rows.select("l_returnflag", "l_linestatus").distinct().collect():
        one = rows.filter((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)).drop("l_returnflag", "l_linestatus")
        one.coalesce(1).write.option("header", True).csv(f"{root}/written/{flag}{status}")
        written = system.globStatus(place(f"{root}/written/{flag}{status}/part-*.csv"))[0].getPath()
        system.mkdirs(place(f"{root}/files"))
        system.rename(written, place(f"{root}/files/Cell_{flag}_{status}.csv"))
    schema = T.StructType([f for f in rows.schema.fields if f.name not in ("l_returnflag", "l_linestatus")])
    return files.read_station_files(spark, f"{root}/files/*.csv", schema).select("station", "lot", "l_orderkey", "l_linenumber", "l_quantity")


@query(
    "S13_managed_table",
    f"WITH {b.WEEKLY} SELECT {_WEEK_KEYS}, maximum_domecasegap FROM weekly WHERE year >= 1996",
)
def managed_table(spark, folder):
    """The weekly history saved as a partitioned table of the catalogue and read by name, some years of it."""
    name = f"history_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'warehouse')}'")
    files.save_table(b.weekly(spark, folder), f"{name}.weekly", ["year"])
    return _longs(spark.table(f"{name}.weekly").filter("year >= 1996"), "year", "week").select("year", "week", "maximum_domecasegap")


@query(
    "S9_two_writers",
    f"WITH {b.WEEKLY} SELECT {_WEEK_KEYS}, maximum_domecasegap, TRUE AS first_wins, TRUE AS second_lost, TRUE AS nothing_of_the_dead FROM weekly WHERE year <= 1997",
)
def two_writers(spark, folder):
    """Two writers find the weeks of 1996 missing at the same time; one adds them, the other sees it and adds only what is still missing. A third one dies before its manifest."""
    weekly = staged(b.weekly(spark, folder).select("year", "week", "maximum_domecasegap"), "weekly")
    history = PeriodTable(spark, scratch_path(spark, "history"), weekly.schema, ["year", "week"])
    early, late = weekly.filter("year <= 1996"), weekly.filter("year between 1996 and 1997")
    one, two = history.prepare(early), history.prepare(late)
    history.prepare(weekly.filter("year > 1997"))
    first, second = history.commit(one), history.commit(two)
    history.append(late, "skip_rows")
    rows = _longs(history.read(), "year", "week")
    dead = rows.filter("year > 1997").isEmpty()
    return rows.withColumns({"first_wins": F.lit(first), "second_lost": F.lit(not second), "nothing_of_the_dead": F.lit(dead)})


@query("T4_scored_stream", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed FROM events")
def scored_stream(spark, folder):
    """Labels of the stream equal those of the batch they were fitted on."""
    rows = b.table(spark, folder, "events").select("event_id", "value")
    model, labelled = IsolationForest(["value"], 917, contamination=0.015).fit_score(rows, ["event_id"])
    live = _run(jobs.scored_stream(_event_stream(spark, folder).select("event_id", "value"), model), "scored", spark)
    both = live.select("event_id", F.col("outlier").alias("live")).join(labelled.select("event_id", "outlier"), "event_id")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("live") != F.col("outlier")).alias("changed"))


@query(
    "T5_weekly_stream",
    """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start, event_type, max(value) AS maximum, min(value) AS minimum, CAST(CAST(avg(value) AS FLOAT) AS DOUBLE) AS mean,
    CAST(CAST(stddev_samp(value) AS FLOAT) AS DOUBLE) AS stddev, count(value) AS rows FROM events GROUP BY 1, 2""",
)
def weekly_stream(spark, folder):
    root = scratch_path(spark, "weekly-stream")
    weekly = jobs.weekly_stream(_event_stream(spark, folder), "ts", "value", "7 days", ["event_type"])
    keys = ["week_start", "event_type"]
    jobs.keep_latest(weekly, keys, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    rows = jobs.read_latest(spark, f"{root}/out", weekly.schema, keys)
    return rows.select(
        F.date_format("week_start", "yyyy-MM-dd").alias("week_start"), "event_type", "maximum", "minimum", rounded("mean").alias("mean"),
        rounded("stddev").alias("stddev"), "rows",
    )


@query("T6_first_arrivals", "SELECT event_id, user_id, value FROM events")
def first_arrivals(spark, folder):
    """Every event arrives twice; one copy of each is kept."""
    live = _event_stream(spark, folder)
    twice = live.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    return _run(jobs.first_arrivals(twice, ["event_id"], "ts", "1 day").select("event_id", "user_id", "value"), "first", spark)


@query(
    "X4_daily_ingest",
    f"""WITH {b.RAW} SELECT testid, batchid, domecasegap, stitcharea, {_WEEK_KEYS} FROM raw WHERE configid = 2 AND year = 1998 AND week = 21""",
)
def daily_ingest(spark, folder):
    """The rows of the week that holds a given day."""
    tables = {n: getattr(b, n)(spark, folder) for n in ("batches", "cells", "limits")} | {"tests": b.day_store(spark, folder)}
    rows = daily.daily_ingest(tables, date(1998, 5, 20), config_id=2, limit_key="cell_id")
    return _longs(rows.select("testid", "batchid", "domecasegap", "stitcharea", "year", "week"), "year", "week")


_IDENT = ["batchid", "blister_id", "stitcharea", "domecasegap", "date"]
_IDENT_SQL = "batchid, blister_id, stitcharea, domecasegap, day"


@query(
    "X5_weekly_forecast",
    f"""WITH RECURSIVE {models.MODEL_SQL}, weekly AS (SELECT year, week, count(*) AS n FROM refined GROUP BY year, week),
    numbered AS (SELECT *, {models.digest_sql(models.CONTENT)} AS _id FROM framed), {labelled_ctes("numbered", models.CONTENT, 917, 0.05)},
    limited AS (SELECT year, week FROM labelled QUALIFY row_number() OVER (PARTITION BY year, week ORDER BY {_IDENT_SQL}) = 1 AND first_value(stitcharea_limit) OVER (PARTITION BY year, week ORDER BY {_IDENT_SQL}) <> ''),
    lines AS (SELECT year, week, avg(stitcharea) OVER w AS ma, stddev_samp(stitcharea) OVER w AS std FROM labelled WHERE outlier = -1
      WINDOW w AS (PARTITION BY year, week ORDER BY {_IDENT_SQL} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
    bands AS (SELECT year, week, avg(ma - 2 * std) AS lower, avg(ma + 2 * std) AS upper FROM lines JOIN limited USING (year, week) GROUP BY year, week),
    latest AS (SELECT year, week, CASE WHEN week >= {b.LAST_WEEK} THEN year + 1 ELSE year END AS ny, CASE WHEN week >= {b.LAST_WEEK} THEN 1 ELSE week + 1 END AS nw,
      (SELECT count(*) FROM weekly) AS known FROM weekly ORDER BY year DESC, week DESC LIMIT 1)
    SELECT CAST(l.week AS BIGINT) AS week, CAST(ny AS BIGINT) AS pred_year, CAST(nw AS BIGINT) AS pred_week,
      CAST(CAST(lower AS FLOAT) AS DOUBLE) AS spc_lower_limit, CAST(CAST(upper AS FLOAT) AS DOUBLE) AS spc_upper_limit, CAST(known <= 20 AS BIGINT) AS additional_records_needed,
      CAST(0 AS BIGINT) AS retrain_required, CASE WHEN known >= 130 THEN known + 12 ELSE 130 END AS next_retraining_qty, CAST(20 AS BIGINT) AS minimum_train_records_qty,
      TRUE AS sum_of_parts, TRUE AS alarm_follows FROM latest l LEFT JOIN bands b ON b.year = l.year AND b.week = l.week""",
)
def weekly_forecast(spark, folder):
    """History, outlier trend, model and alarm log in turn. The alarm row: target week, band of the current week, gates, and whether the forecast is its
    mean and two deviations and the alarm follows from it."""
    root = scratch_path(spark, "forecast")
    refined = staged(b.refined(spark, folder), "refined")
    daily.weekly_history(refined, f"{root}/weekly")
    _, _, labelled = daily.score_rows(refined, _IDENT, seed=917, number=models.digest)
    daily.outlier_trends(labelled, _IDENT, f"{root}/trend")
    state = daily.weekly_forecast(spark, f"{root}/weekly", f"{root}/trend", f"{root}/models", f"{root}/alarms")
    value, low, high = (F.col(c) for c in ("predicted_stitcharea_calculate", "spc_lower_limit", "spc_upper_limit"))
    parts = F.col("pred_stitcharea_week_mean") + 2 * F.col("pred_stitcharea_week_stddev")
    gates = ["additional_records_needed", "retrain_required", "next_retraining_qty", "minimum_train_records_qty"]
    outside = F.coalesce((value < low) | (value > high), F.lit(False)) & (F.col("additional_records_needed") == 0)
    return _longs(state, "week", "pred_year", "pred_week", *gates).select(
        "week", "pred_year", "pred_week", rounded(low).alias("spc_lower_limit"), rounded(high).alias("spc_upper_limit"), *gates,
        (F.abs(value - parts) <= 1e-9 * F.abs(value)).alias("sum_of_parts"), (F.col("alarm_pre_stitcharea") == outside.cast("int")).alias("alarm_follows"),
    )


@query(
    "J5_weekly_bands",
    f"""WITH {b.SERIES}, chart AS (SELECT year, week, seq, avg(domecasegap) OVER w AS ma, stddev_samp(domecasegap) OVER w AS std FROM series
      WINDOW w AS (PARTITION BY year, week ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)), full_rows AS (SELECT year, week, seq, ma - 2 * std AS lower, ma + 2 * std AS upper FROM chart WHERE std IS NOT NULL)
    SELECT {_WEEK_KEYS}, {models.SINGLE("avg(lower)").rsplit(" AS ", 1)[0]} AS mean_lower, {models.SINGLE("avg(upper)").rsplit(" AS ", 1)[0]} AS mean_upper,
      {models.SINGLE("arg_min(lower, seq)").rsplit(" AS ", 1)[0]} AS first_lower, {models.SINGLE("arg_min(upper, seq)").rsplit(" AS ", 1)[0]} AS first_upper FROM full_rows GROUP BY year, week""",
)
def weekly_bands(spark, folder):
    """The band of each week in both forms: the mean of its lines, and its first complete line; another feature's lines do not enter."""
    bands = spc.control_bands(b.series(spark, folder), ["domecasegap"], ["year", "week"], ["seq"]).na.drop("any", subset=["domecasegap_std"])
    lines = bands.select("year", "week", "seq", F.col("domecasegap_spc_lower").alias("spc_lower"), F.col("domecasegap_spc_upper").alias("spc_upper"))
    both = lines.withColumn("feature", F.lit("domecasegap"))
    both = staged(both.unionByName(both.withColumns({"feature": F.lit("other"), "spc_lower": F.lit(0.0), "spc_upper": F.lit(0.0)})), "lines")
    mean, first = alarms.weekly_bands(both, "domecasegap"), alarms.weekly_bands(both, "domecasegap", first_by="seq")
    named = lambda df, name: df.select("year", "week", *[rounded(f"spc_{side}_limit").alias(f"{name}_{side}") for side in ("lower", "upper")])
    return _longs(named(mean, "mean").join(named(first, "first"), ["year", "week"]), "year", "week")


_BOARD = f"""{b.SERIES}, chosen AS (SELECT *, 11.0 + lot % 4 AS cell FROM series WHERE year = 2024 AND week = 2 AND lot % 4 IN (0, 1))"""


@query(
    "X5_dashboard_series",
    f"""WITH {_BOARD} SELECT seq, domecasegap AS value, CAST(CAST(avg(domecasegap) OVER w AS FLOAT) AS DOUBLE) AS ma, CAST(CAST(stddev_samp(domecasegap) OVER w AS FLOAT) AS DOUBLE) AS std
    FROM chosen WINDOW w AS (ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def dashboard_series(spark, folder):
    """The chart behind the dashboard: one week of one year, two cells, with the rolling lines over the chosen rows."""
    rows = staged(b.series(spark, folder).withColumn("tp_cell_name", 11.0 + F.col("lot") % 4), "board")
    board = daily.dashboard(rows, rows, 2, [11.0, 12.0], "domecasegap", ["seq"], year=2024)
    return board["series"].select("seq", "value", rounded("ma").alias("ma"), rounded("std").alias("std"))
