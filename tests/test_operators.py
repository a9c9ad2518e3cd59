from datetime import date

import pytest
from pyspark.sql import functions as F

from sensorwatch import session
from sensorwatch.operators import alarms, guard, kpi, refine as clean, rollup, spc, thresholds
from sensorwatch.operators.encode import CategoryCodes, category_values, number_categories
from sensorwatch.operators.extract import extract
from sensorwatch.schemas import REFINED_COLUMNS


def tables(spark):
    batches = spark.createDataFrame(
        [(1, 917, " L1 ", "A"), (2, 917, "L2", "B"), (3, 5, "L3", "C")], "BatchID long, ConfigID int, LotNumber string, Cell_Name string"
    )
    tests = spark.createDataFrame(
        [
            (10, 1, " Pass\t", "02/01/2023", "01:30", 11.0), (11, 1, "Fail", "03/01/2023", "01:31", 12.0),
            (12, 2, "Pass", "31/02/2023", "00:10", 11.0), (13, 3, "Pass", "02/01/2023", "00:10", 11.0), (14, 2, "Pass", "09/01/2023", "00:20", 11.0),
        ],
        "TestID long, BatchID long, PASS_FAILED string, Date string, Test_Time_min string, Cell_Name double",
    )
    cells = spark.createDataFrame([(i, 10.0 * i, 2.0 * i) for i in range(10, 15)], "TestID long, DomeCaseGap double, StitchArea double")
    limits = spark.createDataFrame([(1, "1:2", ":9"), (1, "1:3", "4:"), (2, " 5:6", "")], "BatchId long, DomeCaseGap string, StitchArea string")
    return batches, tests, cells, limits


def test_extract_by_hand(spark):
    rows = extract(*tables(spark), config_id=917, year=2023)
    found = sorted((r["testid"], r["week"], r["tp_cell_name"], r["cell_name"], r["domecasegap_limit"], r["domecasegap_spc"]) for r in rows.collect())
    assert found == [
        (10, 1, 11.0, "A", "1:2", "80.0:120.0"), (10, 1, 11.0, "A", "1:3", "80.0:120.0"),
        (11, 1, 12.0, "A", "1:2", "88.0:132.0"), (11, 1, 12.0, "A", "1:3", "88.0:132.0"), (14, 2, 11.0, "B", "5:6", "112.0:168.0"),
    ]
    assert {r["lotnumber"] for r in rows.collect()} == {"L1", "L2"}


def test_extract_prunes_a_typed_date(spark, folder):
    batches, tests, cells, limits = tables(spark)
    tests.withColumn("Date", F.lit(date(2023, 1, 2))).write.parquet(f"{folder}/tests")
    typed = spark.read.parquet(f"{folder}/tests")
    plan = extract(batches, typed, cells, limits, 917, year=2023)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Date,2023-01-01)" in plan or "GreaterThanOrEqual(date,2023-01-01)" in plan


def test_refine_by_hand(spark):
    raw = extract(*tables(spark), config_id=917, year=2023)
    extra = [c for c in REFINED_COLUMNS if c not in raw.columns and c != "test_time_sec"]
    full = raw.withColumns({c: F.lit(None).cast("string") for c in extra})
    rows = clean.refine(full)
    assert rows.columns == REFINED_COLUMNS
    assert sorted({(r["batchid"], r["test_time_sec"], r["date"]) for r in rows.collect()}) == [(1, 5400, date(2023, 1, 2)), (2, 1200, date(2023, 1, 9))]
    with pytest.raises(ValueError, match="missing columns"):
        clean.refine(raw)


def test_nan_becomes_null(spark):
    rows = clean.drop_nan(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert sorted(str(r["x"]) for r in rows.collect()) == ["1.0", "None"]


def test_category_codes(spark):
    rows = spark.createDataFrame([(0, "b", 10), (1, None, 2), (2, "a", None), (3, "b", 10)], "i int, t string, n int")
    codes = CategoryCodes.fit(rows, ["t", "n"])
    assert [(r["t"], r["n"]) for r in codes.encode(rows).orderBy("i").collect()] == [(1, 1), (-1, 0), (0, -1), (1, 1)]
    unseen = spark.createDataFrame([("z", 10)], "t string, n int")
    assert [tuple(r) for r in codes.encode(unseen).collect()] == [(-1, 1)]


def test_stored_codes_do_not_shift(spark, folder):
    first = spark.createDataFrame([("b",), ("c",)], "t string")
    CategoryCodes.fit(first, ["t"]).save(f"{folder}/codes")
    later = spark.createDataFrame([("a",), ("c",)], "t string")
    assert [r["t"] for r in CategoryCodes.load(spark, f"{folder}/codes").encode(later).collect()] == [-1, 1]


def test_codes_numbered_in_ranges(spark):
    rows = spark.range(3000).select(F.concat(F.lit("lot-"), (F.col("id") % 997).cast("string")).alias("t"), (F.col("id") % 500 - 250).alias("n"))
    values = category_values(rows, ["t", "n"]).cache()
    plain, ranged = number_categories(values), number_categories(values, max_group_rows=50)
    assert plain.count() == ranged.count() == 997 + 500
    assert plain.exceptAll(ranged.select(*plain.columns)).count() == 0


def test_encoding_a_column_with_many_values(spark, monkeypatch):
    from sensorwatch.operators import encode

    monkeypatch.setattr(encode, "BROADCAST_BYTES", 5)
    rows = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 100).alias("n"))
    coded = CategoryCodes.fit(rows, ["n"]).encode(rows, max_group_rows=50)
    assert coded.filter("n is null or n < -1 or n > 99").count() == 0
    assert coded.filter("n = -1").count() == rows.filter("n is null").count()


def test_control_bands_by_hand(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 4.0)], "seq int, v double")
    found = [(r["ma"], r["std"]) for r in spc.chart_series(rows, "v", [], ["seq"]).orderBy("seq").collect()]
    assert found[0] == (1.0, None)
    assert found[1] == (1.5, pytest.approx(0.70710678)) and found[2] == (pytest.approx(7 / 3), pytest.approx(1.52752523))


def label(spark, labeller, *numbers, **options):
    columns = [F.lit(n).cast("double") for n in numbers]
    return spark.range(1).select(labeller(*columns, **options).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "numbers, code",
    [
        ((1, 9, 2, 8, 0, 10), 0), ((2, 9, 2, 10, 0, 10), 1), ((1, 5, 0.5, 8, 0, 10), 1),
        ((-1, 20, -1.05, 10, 0, 10), 2), ((-20, 20, -20, 10, 0, 10), 3),
        ((5, 20, None, None, 0, 10), 4), ((-1, 5, None, None, 0, 10), 4), ((5, 5, None, None, 0, 10), 5),
    ],
)
def test_trend_labels(spark, numbers, code):
    assert label(spark, spc.trend_label, *numbers) == spc.TREND_LABELS[code]


@pytest.mark.parametrize(
    "numbers, code",
    [((5, 6, 2, 8, 0, 10), 0), ((2.1, 6, 2, 8, 0, 10), 1), ((1, 6, 2, 8, 0, 10), 2), ((3, 9, 2, 8, 0, 10), 3), ((3, 11, 2, 8, 0, 10), 4), ((3, 5, None, None, 0, 10), 5)],
)
def test_strict_trend_labels(spark, numbers, code):
    assert label(spark, spc.trend_label, *numbers, rule="strict") == spc.TREND_LABELS[code]


@pytest.mark.parametrize(
    "numbers, name",
    [
        ((3, 9, 2, 8, 0, 10), "Approaching SPC limits"), ((3, 8.5, 2, 8, 0, 10), "Within SPC limits"),
        ((1, 9, 2, 8, 0, 10), "Within limits"), ((-1, 9, 2, 8, 0, 10), "Out of limits"), ((1, 11, 2, 8, 0, 10), "Out of limits"),
        ((1, 9, None, None, 0, 10), None),
    ],
)
def test_alert_labels(spark, numbers, name):
    assert label(spark, spc.alert_label, *numbers) == name


def test_alert_counts_are_zero_filled(spark):
    rows = spark.createDataFrame([(i, float(i % 5)) for i in range(20)], "seq int, v double")
    bounds = spark.createDataFrame([(0.0, 4.0)], "v_lo_value double, v_hi_value double")
    limits = spark.createDataFrame([(-1.0, 9.0)], "v_lo_limit double, v_hi_limit double")
    found = {r["label"]: (r["value"], r["total"]) for r in spc.alert_counts(rows, bounds, limits, "v", [], ["seq"]).collect()}
    assert set(found) == set(spc.ALERT_LABELS) and sum(v for v, _ in found.values()) == 20
    assert found["Out of SPC limits"] == (0, 20)


def test_trend_skips_a_feature_without_limits(spark):
    rows = spark.createDataFrame([(i, float(i), float(i), "1:2", "") for i in range(15)], "seq int, a double, b double, a_limit string, b_limit string")
    limits = spc.first_limits(rows, ["a", "b"], [], ["seq"])
    trend = spc.spc_trend(rows, limits, ["a", "b"], [], ["seq"])
    assert {r["feature"] for r in trend.select("feature").distinct().collect()} == {"a"} and trend.count() == 15


def test_same_trend_when_groups_are_split(spark):
    rows = spark.range(400).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"), (F.col("id") * 37 % 101).cast("double").alias("a"), F.lit("5:90").alias("a_limit"))
    limits = spc.first_limits(rows, ["a"], ["k"], ["seq"])
    plain = spc.spc_trend(rows, limits, ["a"], ["k"], ["seq"]).withColumns({c: F.round(c, 9) for c in ("ma", "std", "spc_lower", "spc_upper")})
    split = spc.spc_trend(rows, limits, ["a"], ["k"], ["seq"], max_group_rows=20).withColumns({c: F.round(c, 9) for c in ("ma", "std", "spc_lower", "spc_upper")})
    assert plain.exceptAll(split.select(*plain.columns)).count() == 0 and split.count() == 400


def test_weekly_deviation_of_one_row_is_null(spark):
    rows = spark.createDataFrame([(2023, 1, 5.0, 6.0)], "year int, week int, domecasegap double, stitcharea double")
    assert rollup.weekly_rollup(rows).first()["domecasegap_week_stddev"] is None


def test_weekly_moving_average_keeps_empty_weeks(spark):
    days = [date(2023, 1, 2 + 7 * i) if i < 4 else date(2023, 1, 30 + 7 * (i - 4)) for i in range(4)] + [date(2023, 3, 6)]
    rows = spark.createDataFrame([(d, 1.0) for d in days], "d date, v double")
    weekly = spc.weekly_moving_average(rows, "d", "v").orderBy("week_end").collect()
    assert len(weekly) == 10 and weekly[0]["week_end"] == date(2023, 1, 8)
    assert weekly[5]["weekly_mean"] is None and all(r["moving_average"] is None for r in weekly)


def test_latest_of_an_empty_table(spark):
    assert rollup.latest(spark.createDataFrame([], "year int, week int, v double"), ["year", "week"]).count() == 0


def test_outliers_come_first(spark):
    rows = spark.createDataFrame([(1, 1), (2, -1), (3, 1), (4, -1)], "seq int, outlier int")
    assert [r["seq"] for r in rollup.outliers_first(rows, ["seq"]).collect()] == [2, 4, 1, 3]


def test_first_groups_in_order_of_appearance(spark):
    rows = spark.createDataFrame([("z", 1), ("a", 2), ("z", 3), ("m", 4), ("a", 5), ("q", 6), ("q", 7)], "k string, seq int")
    assert [r["k"] for r in rollup.first_groups(rows, ["k"], ["seq"], 2, 2).collect()] == ["z", "a"]


def test_kpi_without_limits_or_outliers(spark):
    rows = spark.createDataFrame([(1.0, "", 1), (3.0, ":", 1)], "v double, v_limit string, outlier int")
    found = kpi.outlier_kpi(rows, "v").first()
    assert found["outlier_vs_normal"] == "0.000%" and found["outlier_count"] == 0
    assert found["mean_normal_feature"] == "2.000" and tuple(found["limit_feature"]) == (0.0, 0.0)


def test_evaluation_without_normals(spark):
    rows = spark.createDataFrame([(1.0, -1)], "v double, outlier int")
    found = kpi.outlier_evaluation(rows, ["v"]).first()
    assert found["ratio"] is None and found["amount"] == 1


def test_guard(spark, folder):
    stored = spark.createDataFrame([(2023, 5, 1.0)], "year int, week int, v double")
    new = spark.createDataFrame([(2023, 5, 2.0), (2023, 6, 3.0)], "year int, week int, v double")
    for rule, wanted in (("skip_batch", [(5, 1.0)]), ("skip_rows", [(5, 1.0), (6, 3.0)])):
        path = f"{folder}/{rule}"
        guard.append_new_periods(stored, path, ["year", "week"], rule, ["year"])
        guard.append_new_periods(new, path, ["year", "week"], rule, ["year"])
        guard.append_new_periods(new, path, ["year", "week"], rule, ["year"])
        assert sorted((r["week"], r["v"]) for r in spark.read.parquet(path).collect()) == wanted
    with pytest.raises(ValueError):
        guard.new_period_rows(new, stored, ["year"], "other")


def forecast(spark, value, lower, upper):
    return spark.createDataFrame([(52, 2023, 1, value, lower, upper)], "week int, pred_year int, pred_week int, predicted_stitcharea_calculate double, spc_lower_limit double, spc_upper_limit double")


@pytest.mark.parametrize(
    "n, flags",
    [(19, (0, 0, 1)), (20, (0, 0, 1)), (21, (1, 0, 0)), (129, (1, 0, 0)), (130, (0, 1, 0)), (131, (0, 1, 0))],
)
def test_alarm_gates(spark, n, flags):
    row = alarms.alarm_state(forecast(spark, 9.0, 1.0, 8.0), F.lit(n), 20, 130).first()
    assert (row["alarm_pre_stitcharea"], row["retrain_required"], row["additional_records_needed"]) == flags


def test_alarm_messages(spark):
    state = lambda *band: alarms.alarm_state(forecast(spark, *band), F.lit(50), 20, 130).first()
    assert state(9.0, 1.0, 8.0)["message"] == "Alarm: predicted_stitcharea 9.000000 for week: 1 is out of SPC limits 1.000000: 8.000000"
    assert state(5.5, 1.0, 8.0)["message"] == "No Alarm: predicted_stitcharea 5.500000 for week: 1 is within SPC limits 1.000000: 8.000000"
    missing = state(5.5, None, None)
    assert missing["alarm_pre_stitcharea"] == 0 and missing["message"].endswith("limits nan: nan")


def test_status_colours(spark):
    state = alarms.alarm_state(forecast(spark, 9.0, 1.0, 8.0), F.lit(50), 20, 130)
    assert alarms.status(state).first()["color"] == "red"
    assert alarms.status(state.withColumn("alarm_pre_stitcharea", F.lit(0))).first()["color"] == "green"
    assert alarms.status(state.limit(0)).collect()[0]["color"] == "yellow"


def test_next_training_size(spark):
    size = lambda n: spark.range(1).select(alarms.next_training_size(F.lit(n), 130)).first()[0]
    assert [size(129), size(130), size(140)] == [130, 142, 152]


def test_drift_of_a_flat_and_a_rising_series(spark):
    rows = spark.createDataFrame([("f", i, 5.0) for i in range(4)] + [("r", i, float(i)) for i in range(4)], "k string, seq int, v double")
    found = {r["k"]: (r["slope"], r["steps_to_limit"]) for r in spc.drift(rows, "v", "seq", ["k"], 0.0, 9.0).collect()}
    assert found == {"f": (0.0, None), "r": (1.0, 6.0)}


def test_default_thresholds(spark):
    rows = spark.createDataFrame([("a", 5.0), ("b", 5.0)], "k string, v double")
    limits = spark.createDataFrame([("a", 0.0, 4.0)], "k string, lo_limit double, hi_limit double")
    checked = thresholds.check_limits(thresholds.with_thresholds(rows, limits, ["k"], {"lo_limit": 1.0, "hi_limit": 9.0}), "v")
    assert {r["k"]: r["zone"] for r in checked.collect()} == {"a": "above", "b": "inside"}


def test_large_partitions_of_the_extract_are_split(spark, monkeypatch):
    """Two partitions of equal size, each too large for one task; before, only one that was five times as large as the others was split."""
    factor, size = session.JOIN_SPLITS
    monkeypatch.setitem(session.JOIN_SPLITS, size, "8KB")
    old = {k: spark.conf.get(k) for k in (factor, size, "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.unset(factor)
    try:
        for k, v in zip(list(old)[2:], ("2", "-1", "8KB")):
            spark.conf.set(k, v)
        batches = spark.range(400).selectExpr("id AS BatchID", "1 AS ConfigID")
        rows = spark.range(0, 20_000, 1, 8).selectExpr("id % 400 AS BatchID", "id % 50 AS TestID", "date'2024-01-01' AS Date", "CAST(id AS DOUBLE) AS DomeCaseGap", "1.0D AS StitchArea", "id % 3 AS Cell_ID")
        cells, limits = spark.range(50).selectExpr("id AS TestID"), spark.range(3).selectExpr("id AS Cell_ID", "':1' AS DomeCaseGap", "':2' AS StitchArea")
        found = extract(batches, rows, cells.hint("broadcast"), limits.hint("broadcast"), limit_key="cell_id").select("domecasegap", F.spark_partition_id().alias("p")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(r["domecasegap"] for r in found) == [float(i) for i in range(20_000)]
    assert len({r["p"] for r in found}) > 4
