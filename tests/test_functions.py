from datetime import date

import pytest
from pyspark.sql import functions as F

from sensorwatch.functions import calendar, limits, text


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in rows.select(expression(F.col("c")).alias("x"), "i").orderBy("i").collect()]


def test_server_week_by_hand(spark):
    days = [date(2023, 1, 1), date(2023, 1, 7), date(2023, 1, 8), date(2022, 1, 1), date(2022, 1, 2), date(2000, 12, 31)]
    assert column(spark, days, "date", calendar.server_week) == [1, 1, 2, 1, 2, 54]


def test_server_week_counts_sundays(spark):
    rows = spark.sql("select explode(sequence(date'1999-01-01', date'2012-12-31')) as d")
    sundays = F.expr("size(filter(sequence(date_add(trunc(d, 'year'), 1), greatest(d, date_add(trunc(d, 'year'), 1))), x -> dayofweek(x) = 1 and x <= d))")
    assert rows.filter(calendar.server_week(F.col("d")) != sundays + 1).count() == 0


def test_day_first_dates(spark):
    texts = ["31/02/2023", "05/07/2023", "5/7/2023", "2023-07-05", "05/07/23", "05/07/2023/1", "05 x/07/2023", "", None]
    wanted = [None, date(2023, 7, 5), date(2023, 7, 5)] + [None] * 6
    assert column(spark, texts, "string", calendar.day_first_date) == wanted
    with pytest.raises(Exception):
        column(spark, ["31/02/2023"], "string", lambda c: calendar.day_first_date(c, strict=True))


def test_clock_seconds(spark):
    texts = ["01:30", "00:00", "23:59", "24:00", "10:60", "x", "1:2:3", "-1:10", None]
    assert column(spark, texts, "string", calendar.clock_seconds) == [5400, 0, 86340, None, None, None, None, None, None]


def test_following_week(spark):
    rows = spark.createDataFrame([(2022, 51), (2022, 52), (2022, 53), (2000, 53), (2000, 54), (2020, 52), (2020, 53)], "y int, w int")

    def following(rule):
        return [tuple(r) for r in rows.select(*calendar.following_week(F.col("y"), F.col("w"), rule)).collect()]

    assert following("server") == [(2022, 52), (2022, 53), (2023, 1), (2000, 54), (2001, 1), (2020, 53), (2021, 1)]
    assert following("iso") == [(2022, 52), (2023, 1), (2023, 1), (2001, 1), (2001, 1), (2020, 53), (2021, 1)]
    assert following("compat")[:3] == [(2022, 52), (2023, 1), (2023, 1)]


def test_iso_weeks_carry_their_year(spark):
    days = spark.createDataFrame([(date(2024, 12, 31),), (date(2020, 12, 31),), (date(2021, 1, 1),), (date(2023, 7, 3),)], "d date")
    parts = calendar.with_calendar_parts(days, F.col("d"), "iso").select("year", "week")
    assert [tuple(r) for r in parts.collect()] == [(2025, 1), (2020, 53), (2020, 53), (2023, 27)]
    assert calendar.current_period(date(2024, 12, 31), week_rule="iso") == {"year": 2025, "yearweek": 1}


def test_dates_are_digits(spark):
    assert column(spark, ["5T/07/2023", "5 /07/2023", "5/7/2023", "+5/07/2023"], "string", calendar.day_first_date) == [None, None, date(2023, 7, 5), None]


def test_current_period_agrees_with_the_column_rule(spark):
    days = [date(2022, 1, 1), date(2023, 7, 3), date(2024, 12, 31), date(2000, 12, 31)]
    assert [calendar.current_period(d)["yearweek"] for d in days] == column(spark, days, "date", calendar.server_week)
    assert calendar.current_period(date(2023, 7, 3), history_year=2022) == {"year": 2022}
    assert calendar.current_period(date(2023, 7, 3), week_rule="iso") == {"year": 2023, "yearweek": 27}


def test_period_precedence(spark):
    rows = spark.createDataFrame([(2023, 1, 2, 6, 3), (2023, 1, 3, 9, 3), (2023, 2, 4, 14, 5)], "year int, quarter int, month int, week int, dayweek int")
    count = lambda **p: rows.filter(calendar.period_predicate(**p)).count()
    assert count(year=2023) == 3
    assert count(quarter=1, month=4, yearweek=14) == 2
    assert count(month=3, yearweek=14) == 1
    assert count(yearweek=14, weekday=3) == 0
    assert count(weekday=3) == 2
    assert count(quarter=0, month=0, yearweek=6) == 1


def test_strip_removes_every_kind_of_white_space(spark):
    assert column(spark, [" Pass\t", " a b\n", "", None], "string", text.strip) == ["Pass", "a b", "", None]


def test_lower_names_refuses_clashes(spark):
    assert text.lower_names(spark.range(1).withColumnRenamed("id", "PASS_FAILED")).columns == ["pass_failed"]
    with pytest.raises(ValueError, match="collide"):
        text.lower_names(spark.sql("select 1 as A, 2 as a"))


def test_positional_names_and_required_columns(spark):
    rows = spark.sql("select 1, 2")
    assert text.name_positionally(rows, ["a", "b"]).columns == ["a", "b"]
    with pytest.raises(ValueError, match="expected 3"):
        text.name_positionally(rows, ["a", "b", "c"])
    with pytest.raises(ValueError, match=r"missing columns: \['c'\]"):
        text.require_columns(rows.toDF("a", "b"), ["a", "c"])


def test_fixed_text_rounds_like_printf(spark):
    values = [0.5625, 1.0, 2.6755, -0.4567, 1234567.8, 31.0625, None]
    wanted = [f"{v:.3f}" if v is not None else None for v in values]
    assert column(spark, values, "double", text.fixed_text) == wanted
    assert column(spark, [0.123456], "double", text.percent_text) == ["12.346%"]


def test_announced_rows(spark):
    assert column(spark, ["file_size:12", "{}", "file_size:x"], "string", text.announced_rows) == [12, None, None]


INF = float("inf")


@pytest.mark.parametrize(
    "policy, wanted",
    [
        ("open", [(-INF, 5.0), (1.0, INF), (-INF, INF), None, (1.0, 2.0), None]),
        ("zero", [(0.0, 5.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (1.0, 2.0), None]),
        ("skip", [(None, 5.0), (1.0, None), (None, None), (None, None), (1.0, 2.0), None]),
    ],
)
def test_range_policies(spark, policy, wanted):
    found = column(spark, [":5", "1:", ":", "", " 1 : 2 ", None], "string", lambda c: limits.parse_range(c, policy))
    assert [tuple(r) if r is not None else None for r in found] == wanted


def test_range_text_of_missing_value(spark):
    assert column(spark, [10.0, None], "double", limits.range_text) == ["8.0:12.0", ":"]


def test_limit_zones(spark):
    zone = lambda c: limits.limit_zone(c, F.lit(10.0), F.lit(100.0))
    assert column(spark, [9.0, 10.5, 11.0, 50.0, 90.0, 101.0, None], "double", zone) == ["below", "near", "near", "inside", "near", "above", None]
