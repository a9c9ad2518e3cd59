"""The daily and weekly jobs end to end, and the shape of the plans."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE
from sensorwatch.functions.text import lower_names
from sensorwatch.operators import spc
from sensorwatch.operators.refine import refine
from sensorwatch.operators.rollup import weekly_rollup
from sensorwatch.plans import jobs
from sensorwatch.plans.catalog import QUERIES, bindings as b
from sensorwatch.schemas import ALARMS, WEEKLY
from sensorwatch.sources import messages
from sensorwatch.sources.files import read_snapshot
from sensorwatch.streaming.jobs import FramedBatches


def tables(spark):
    found = {n: getattr(b, n)(spark, SAMPLE) for n in ("batches", "tests", "cells", "limits")}
    return found


def test_daily_ingest_takes_one_week_or_one_year(spark):
    week = jobs.daily_ingest(tables(spark), date(1998, 5, 20), config_id=1, limit_key="cell_id")
    assert [tuple(r) for r in week.select("year", "week", "configid").distinct().collect()] == [(1998, 21, 1)]
    year = jobs.daily_ingest(tables(spark), date(2023, 5, 20), history_year=1998, config_id=1, limit_key="cell_id")
    assert [r["year"] for r in year.select("year").distinct().collect()] == [1998]
    assert year.select("week").distinct().count() > 40


def test_from_messages_to_alarms(spark, folder):
    """Extract, publish, consume, refine, score, label, keep weekly history, forecast, alarm; run twice."""
    rows = jobs.daily_ingest(tables(spark), date(2023, 1, 1), history_year=1998, config_id=1, limit_key="cell_id")
    rows = rows.withColumn("row_no", F.monotonically_increasing_id())
    sent = messages.to_messages(rows, "1998", ["row_no"])
    messages.publish(sent, {}, "text", f"{folder}/topic")
    consumed = []

    def consume(frames, batch):
        raw = messages.decode_rows(frames.drop("row_no"), rows.schema)
        refined = refine(raw)
        jobs.weekly_history(refined, f"{folder}/weekly")
        consumed.append(refined.count())

    frames = messages.decode_frames(messages.read_stream(spark, {}, "text", f"{folder}/topic"))
    for _ in range(2):
        FramedBatches(f"{folder}/frames", consume).start(frames, f"{folder}/checkpoint").awaitTermination()
    refined = refine(rows)
    assert consumed == [refined.count()]

    weekly = read_snapshot(spark, f"{folder}/weekly", WEEKLY)
    assert weekly.count() == refined.select("year", "week").distinct().count()
    jobs.weekly_history(refined, f"{folder}/weekly")
    assert read_snapshot(spark, f"{folder}/weekly", WEEKLY).count() == weekly.count()

    ident = [*["batchid", "blister_id", "stitcharea", "domecasegap", "date"]]
    model, codes, labelled = jobs.score_rows(refined, ident, seed=7, trees=20)
    flagged = labelled.filter("outlier = -1").count()
    assert 0 < flagged <= 0.05 * refined.count() + 1
    trend = jobs.outlier_trends(labelled, ident, f"{folder}/trend")
    jobs.outlier_trends(labelled, ident, f"{folder}/trend")
    assert spark.read.parquet(f"{folder}/trend").count() == trend.count()

    for _ in range(2):
        state = jobs.weekly_forecast(spark, f"{folder}/weekly", f"{folder}/trend", f"{folder}/models", f"{folder}/alarms", 20, 130)
    log = read_snapshot(spark, f"{folder}/alarms", ALARMS)
    row = log.first()
    last = weekly.orderBy(F.desc("week")).first()
    assert log.count() == 1 and state.count() == 1
    assert (row["week"], row["pred_year"], row["pred_week"]) == (last["week"], 1999 if last["week"] >= 52 else 1998, 1 if last["week"] >= 52 else last["week"] + 1)
    assert row["retrain_required"] == 0 and row["additional_records_needed"] == 0
    assert row["predicted_stitcharea_calculate"] == pytest.approx(row["pred_stitcharea_week_mean"] + 2 * row["pred_stitcharea_week_stddev"])

    board = jobs.dashboard(labelled, refined, 20, [11.0, 12.0], "stitcharea", ident)
    chosen = labelled.filter("week = 20 and tp_cell_name in (11.0, 12.0)").count()
    assert board["series"].count() == chosen and board["alerts"].count() == 5
    assert board["alerts"].first()["total"] == chosen and board["limits"].count() == 1


def test_first_forecast_without_a_trend_and_the_schedule_between_runs(spark, folder):
    """No trend table: no band, no alarm. The size for the next training is read from the log: a second run does not train again."""
    weekly = weekly_rollup(b.refined(spark, SAMPLE)).orderBy("year", "week").limit(41)
    weeks = sorted((r["year"], r["week"]) for r in weekly.collect())
    paths = [f"{folder}/{n}" for n in ("weekly", "no-trend", "models", "alarms")]
    for upto, trains, size in ((39, True, 51), (40, False, 51), (41, False, 51)):
        rows = weekly.filter(F.struct("year", "week") <= F.struct(*[F.lit(x) for x in weeks[upto - 1]]))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year").parquet(paths[0])
        before = {p: p.stat().st_mtime_ns for p in Path(paths[2]).rglob("*") if p.is_file()}
        state = jobs.weekly_forecast(spark, *paths, 20, 39).first()
        after = {p: p.stat().st_mtime_ns for p in Path(paths[2]).rglob("*") if p.is_file()}
        assert (before != after) == trains
        assert state["next_retraining_qty"] == size and state["retrain_required"] == 0 and state["alarm_pre_stitcharea"] == 0
        assert state["spc_lower_limit"] is None and "nan: nan" in state["message"]
    assert read_snapshot(spark, paths[3], ALARMS).count() == 3


def test_forecast_needs_enough_history(spark, folder):
    few = weekly_rollup(b.refined(spark, SAMPLE)).limit(5)
    few.write.partitionBy("year").parquet(f"{folder}/weekly")
    state = jobs.weekly_forecast(spark, f"{folder}/weekly", f"{folder}/none", f"{folder}/models", f"{folder}/alarms", 20, 130)
    assert state.count() == 0 and state.columns == ALARMS.fieldNames()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extract_prunes_columns_and_broadcasts_small_tables(spark):
    text = plan(b.weekly(spark, SAMPLE))
    assert "l_tax" not in text and "p_retailprice" not in text and "BroadcastHashJoin" in text


def test_configuration_filter_reaches_the_batch_rows_before_the_join(spark):
    text = plan(b.raw(spark, SAMPLE, config_id=1, year=1997))
    assert text.index("Join") < text.index("substring(o_orderpriority") or "substr(o_orderpriority" in text


@pytest.mark.parametrize("name", ["W1_W2_W5_chart_series", "L1_A6_group_trend_labels", "A3_outlier_kpi", "A1_weekly_rollup", "A13_percentile_thresholds"])
def test_keyed_queries_have_no_single_partition(spark, name):
    text = plan(QUERIES[name](spark, SAMPLE))
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_row_at_a_time_python(spark):
    for name in ("A1_weekly_rollup", "P4_P6_P7_refined_rows", "W3_L1_trend_per_lot", "J6_L9_rows_against_limits"):
        text = plan(QUERIES[name](spark, SAMPLE))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_period_of_a_typed_date_is_pushed_to_the_scan(spark):
    items = b.table(spark, SAMPLE, "lineitem").select(F.col("l_orderkey").alias("BatchID"), F.col("l_partkey").alias("TestID"), F.col("l_shipdate").alias("Date"), F.col("l_suppkey").alias("Cell_ID"))
    from sensorwatch.operators.extract import extract

    rows = extract(b.batches(spark, SAMPLE), items, b.cells(spark, SAMPLE), b.limits(spark, SAMPLE), year=1997, limit_key="cell_id")
    assert "GreaterThanOrEqual(l_shipdate," in plan(rows)
    assert rows.select("year").distinct().count() == 1


def test_first_limits_use_an_aggregate(spark):
    rows = lower_names(b.series(spark, SAMPLE))
    assert "Window" not in plan(spc.first_limits(rows, ["domecasegap"], ["lot"], ["seq"]))
