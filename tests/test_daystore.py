"""The day store: typed days, pruned partitions, and the same extract as over text dates."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE
from sensorwatch.functions import calendar
from sensorwatch.operators.extract import extract
from sensorwatch.plans.catalog import bindings as b
from sensorwatch.sources.daystore import TEST_YEAR, DayStore

PERIODS = [
    dict(year=1998, quarter=2, month=9, yearweek=3), dict(year=1998, month=9, yearweek=3, weekday=2), dict(year=1998, yearweek=30, weekday=4),
    dict(year=1998, weekday=1), dict(year=1997), dict(year=1998, yearweek=21),
]


def formatted(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("period", PERIODS, ids=str)
def test_periods_prune_partitions_and_parse_nothing(spark, period):
    rows = b.stored(spark, SAMPLE, **period)
    text = formatted(rows)
    scan = next(line for line in text.splitlines() if "FileScan" in line and TEST_YEAR in line)
    assert f"({TEST_YEAR}#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(date," in scan
    assert "split_part" not in text and "substring(Date" not in text and "try_cast" not in text
    plain = b.raw(spark, SAMPLE, **period)
    assert sorted(rows.columns) == sorted(plain.columns)
    same = [c for c in plain.columns if c != "date"]
    assert rows.select(same).exceptAll(plain.select(same)).count() == 0 and rows.count() == plain.count() > 0


def test_years_without_a_batch_of_the_configuration_are_not_read(spark, folder):
    """Configuration 1 has tests in 2021 only: the partitions of the other years are pruned while the query runs."""
    batches = spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "batchid long, configid int")
    tests = spark.createDataFrame([(10, 1, "01/02/2021"), (11, 2, "03/02/2022"), (12, 2, "04/02/2023"), (13, 3, "05/02/2021"), (14, 3, "x")], "testid long, batchid long, date string")
    cells = spark.createDataFrame([(i, 1.0) for i in range(10, 15)], "testid long, leaktest double")
    limits = spark.createDataFrame([(i, "1:2") for i in (1, 2, 3)], "batchid long, leaktest string")
    store = DayStore(folder)
    store.append(tests)
    rows = extract(batches, store, cells, limits, config_id=1)
    assert "dynamicpruning" in formatted(rows)
    rows.collect()
    assert {r["testid"] for r in rows.filter("year is not null").collect()} == {10, 13}
    assert {r["testid"] for r in extract(batches, store, cells, limits).collect()} == {10, 11, 12, 13, 14}


def test_a_day_of_any_size_is_written_by_several_tasks(spark, folder):
    tests = spark.range(0, 40_000, 1, 8).select(F.col("id").alias("testid"), (F.col("id") % 7).alias("batchid"), F.lit("05/02/2021").alias("date"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        DayStore(folder).append(tests)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = DayStore(folder).tests(spark)
    assert stored.select("testid").distinct().count() == stored.count() == 40_000
    assert stored.columns == ["testid", "batchid", "date", TEST_YEAR] and len(stored.inputFiles()) > 1


@pytest.mark.parametrize("rule", ["server", "iso"])
def test_days_of_a_period_hold_all_of_it(spark, rule):
    days = [(date(2019, 12, 20) + timedelta(days=i),) for i in range(2240)]
    parts = calendar.with_calendar_parts(spark.createDataFrame(days, "day date"), F.col("day"), rule).collect()
    for year in range(2020, 2026):
        periods = [dict(quarter=q) for q in range(1, 5)] + [dict(month=m) for m in range(1, 13)] + [dict(yearweek=w) for w in range(1, 55)] + [dict(weekday=3), {}]
        for period in periods:
            first, last = calendar.period_days(year=year, **period, week_rule=rule)
            name = {"quarter": "quarter", "month": "month", "yearweek": "week", "weekday": "dayweek"}
            held = [r["day"] for r in parts if r["year"] == year and all(r[name[k]] == v for k, v in period.items())]
            assert all(first <= d <= last for d in held)
            if period and "weekday" not in period and rule == "server":
                assert not held or (min(held), max(held)) == (first, last)
    assert calendar.period_days(month=3) is None


def test_dates_of_ten_characters_and_less(spark):
    texts = ["05/07/2023", "5/7/2023", "31/02/2023", "05-07-2023", "05/07/23", " 5/07/2023", "0a/07/2023", "05/07/2023x", "05/1 /2023", "+5/07/2023", "1/12/2023", None, "", "05/07/+202"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(calendar.day_first_date(F.col("t")).alias("d"))
    july = date(2023, 7, 5)
    assert [r["d"] for r in rows.collect()] == [july, july, None, None, None, None, None, None, None, None, date(2023, 12, 1), None, None, None]
