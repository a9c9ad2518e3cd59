"""Dates, calendar parts and periods."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

DAY_FIRST = "dd/MM/yyyy"


def day_first_date(text: Column, strict: bool = False) -> Column:
    """Day/month/year text as a date; unreadable text is NULL unless strict.

    The parts are put in ISO order and cast, which is several times faster than a format pattern; the usual ten
    characters by position, anything shorter part by part.
    """
    if strict:
        return F.to_date(text, DAY_FIRST)
    at = lambda first, size: F.substring(text, first, size)
    padded = (F.length(text) == 10) & (at(3, 1) == "/") & (at(6, 1) == "/")
    by_place = F.concat(at(7, 4), F.lit("-"), at(4, 2), F.lit("-"), at(1, 2))
    day, month, year, rest = (F.split_part(text, F.lit("/"), F.lit(i)) for i in (1, 2, 3, 4))
    digits_only = lambda parts: F.translate(parts, "0123456789", "") == ""
    shaped = (F.length(text) < 10) & (F.length(day) <= 2) & (F.length(month) <= 2) & (F.length(year) == 4) & (rest == "")
    return F.when(padded & (F.translate(by_place, "0123456789", "") == "--"), by_place.try_cast("date")).when(
        shaped & digits_only(F.concat(day, month, year)), F.concat_ws("-", year, month, day).try_cast("date")
    )


def server_week(day: Column) -> Column:
    """Week of the year with weeks starting on Sunday and 1 January always in week 1 (1..54)."""
    jan_first_offset = F.dayofweek(F.trunc(day, "year")) - 1
    return F.floor((F.dayofyear(day) - 1 + jan_first_offset) / 7).cast("int") + 1


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def iso_year(day: Column) -> Column:
    """Year that the ISO week belongs to: the last days of December may lie in week 1 of the next one."""
    return F.extract(F.lit("YEAROFWEEK"), day)


def with_calendar_parts(df: DataFrame, day: Column, week_rule: str = "server") -> DataFrame:
    """Add year, quarter, month, week and dayweek (Sunday = 1). With ISO weeks the year is that of the week."""
    server = week_rule == "server"
    week = server_week(day) if server else iso_week(day)
    return df.withColumns(
        {
            "year": F.year(day) if server else iso_year(day),
            "quarter": F.quarter(day),
            "month": F.month(day),
            "week": week,
            "dayweek": F.dayofweek(day),
        }
    )


def period_predicate(year=None, quarter=None, month=None, yearweek=None, weekday=None) -> Column:
    """Filter on calendar parts. Quarter wins over month, month over week; a weekday narrows a week
    or stands alone. Unset (None or 0) parts do not filter."""
    chosen: dict[str, int] = {}
    if quarter:
        chosen["quarter"] = quarter
    elif month:
        chosen["month"] = month
    else:
        if yearweek:
            chosen["week"] = yearweek
        if weekday:
            chosen["dayweek"] = weekday
    if year:
        chosen["year"] = year
    predicate = F.lit(True)
    for name, wanted in chosen.items():
        predicate = predicate & (F.col(name) == wanted)
    return predicate


def period_days(year=None, quarter=None, month=None, yearweek=None, weekday=None, week_rule: str = "server") -> tuple[date, date] | None:
    """First and last day that a period can hold, which a columnar scan can use to skip; None without a year.

    The order of precedence is that of `period_predicate`; the range may hold more days than the period, never fewer.
    """
    if not year:
        return None
    first, last = date(year, 1, 1), date(year, 12, 31)
    if week_rule == "iso":  # weeks belong to the year of their Thursday
        first, last = first - timedelta(days=3), last + timedelta(days=3)
    if quarter or month:
        start, size = (3 * quarter - 2, 3) if quarter else (month, 1)
        if not 1 <= start <= 12:
            return first, last
        end = date(year + (start + size > 12), (start + size - 1) % 12 + 1, 1) - timedelta(days=1)
        # The year of an ISO week may begin or end in the neighbouring calendar year.
        return (date(year, start, 1), end) if week_rule != "iso" or 1 < start and start + size <= 12 else (first, last)
    if yearweek and 1 <= yearweek <= 54:
        if week_rule == "iso":
            monday = date(year, 1, 4) - timedelta(days=date(year, 1, 4).weekday())
        else:
            monday = date(year, 1, 1) - timedelta(days=date(year, 1, 1).isoweekday() % 7)
        start = monday + timedelta(weeks=yearweek - 1)
        return max(first, start), min(last, start + timedelta(days=6))
    return first, last


def current_period(as_of: date, history_year: int | None = None, week_rule: str = "server") -> dict:
    """Period of the daily job: one whole past year, or the week that holds the given day."""
    if history_year:
        return {"year": history_year}
    if week_rule == "iso":
        return dict(zip(("year", "yearweek"), as_of.isocalendar()))
    jan_first = date(as_of.year, 1, 1)
    week = ((as_of - jan_first).days + jan_first.isoweekday() % 7) // 7 + 1
    return {"year": as_of.year, "yearweek": week}


def last_week(year: Column, week_rule: str = "server") -> Column:
    """Number of the last week of a year: 53 or 54 by the server rule, 52 or 53 by ISO."""
    if week_rule == "iso":
        return iso_week(F.make_date(year, F.lit(12), F.lit(28)))
    return server_week(F.make_date(year, F.lit(12), F.lit(31)))


def following_week(year: Column, week: Column, week_rule: str = "server") -> tuple[Column, Column]:
    """Year and number of the next week. By the `compat` rule weeks 52 and later all lead to week 1."""
    rolls = week >= (F.lit(52) if week_rule == "compat" else last_week(year, week_rule))
    return year + rolls.cast("int"), F.when(rolls, F.lit(1)).otherwise(week + 1)


def clock_seconds(text: Column) -> Column:
    """`HH:MM` text as seconds; anything outside 00:00..23:59 is NULL."""
    hour, minute, rest = (F.split_part(text, F.lit(":"), F.lit(i)) for i in (1, 2, 3))
    shaped = F.length(hour).between(1, 2) & F.length(minute).between(1, 2) & (rest == "")
    h, m = hour.try_cast("int"), minute.try_cast("int")
    return F.when(shaped & h.between(0, 23) & m.between(0, 59), (h * 60 + m) * 60)


def epoch_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def sunday_ending(day: Column) -> Column:
    """Last day (Sunday) of the Monday week that holds the day."""
    return F.date_add(F.date_trunc("week", day).cast("date"), 6)
