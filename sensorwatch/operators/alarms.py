"""Forecast alarms: state, messages, schedule and status."""

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import following_week
from ..functions.text import fixed_text

TARGET = "stitcharea"


def weekly_bands(trend: DataFrame, feature: str | None = None, first_by: str | None = None) -> DataFrame:
    """One band per (year, week): that of the first row by `first_by`, or the mean of the band lines."""
    rows = trend.filter(F.col("feature") == feature) if feature else trend
    pick = (lambda c: F.min_by(c, first_by)) if first_by else F.avg
    return rows.groupBy("year", "week").agg(
        pick("spc_lower").alias("spc_lower_limit"), pick("spc_upper").alias("spc_upper_limit")
    )


def forecast_rows(predictions: DataFrame, bands: DataFrame, sigma: float = 2.0, week_rule: str = "server") -> DataFrame:
    """Predicted mean, deviation and mean + sigma * deviation beside the band of the current week.

    `predictions` holds year, week and `pred_stitcharea_week_mean` / `..._stddev`; the target week
    is the one after.
    """
    year, week = following_week(F.col("year"), F.col("week"), week_rule)
    banded = predictions.join(bands, ["year", "week"], "left")
    value = F.col(f"pred_{TARGET}_week_mean") + sigma * F.col(f"pred_{TARGET}_week_stddev")
    return banded.select(
        "week", year.cast("int").alias("pred_year"), week.cast("int").alias("pred_week"), f"pred_{TARGET}_week_mean",
        f"pred_{TARGET}_week_stddev", "spc_lower_limit", "spc_upper_limit",
        value.alias(f"predicted_{TARGET}_calculate"),
    )


# Texts of the alarm messages.
ALARM_TEXT = "Alarm: predicted_stitcharea {value} for week: {week} is out of SPC limits {lower}: {upper}"
NO_ALARM_TEXT = "No Alarm: predicted_stitcharea {value} for week: {week} is within SPC limits {lower}: {upper}"
MORE_DATA_TEXT = "Need to have more data for prediction model training...."
RETRAIN_TEXT = "Need to re-train the data....."


def alarm_message(value: Column, week: Column, lower: Column, upper: Column, alarm: Column) -> Column:
    """Numbers with six decimals; a missing band reads `nan`."""
    number = lambda c: F.coalesce(fixed_text(c, 6), F.lit("nan"))
    parts = [number(value), F.coalesce(week.cast("string"), F.lit("nan")), number(lower), number(upper)]

    def fill(text: str) -> Column:
        return F.format_string(re.sub(r"\{\w+\}", "%s", text), *parts)

    return F.when(alarm, fill(ALARM_TEXT)).otherwise(fill(NO_ALARM_TEXT))


def alarm_state(rows: DataFrame, weeks: DataFrame | Column, min_records: int, next_train: int | Column) -> DataFrame:
    """Alarm, need of more data, or need to re-train, with a message.

    `weeks` is the weekly history, counted inside the plan, or a column that already holds the count.
    """
    known = weeks if isinstance(weeks, Column) else weeks.agg(F.count(F.lit(1))).scalar()
    next_train = next_train if isinstance(next_train, Column) else F.lit(next_train)
    rows = rows.withColumns({"_n": known, "_next": next_train.cast("long")})
    value, lower, upper = (F.col(c) for c in (f"predicted_{TARGET}_calculate", "spc_lower_limit", "spc_upper_limit"))
    few, many = F.col("_n") <= min_records, F.col("_n") >= F.col("_next")
    outside = F.coalesce((value < lower) | (value > upper), F.lit(False))
    message = (
        F.when(few, F.lit(MORE_DATA_TEXT))
        .when(many, F.lit(RETRAIN_TEXT))
        .otherwise(alarm_message(value, F.col("pred_week"), lower, upper, outside))
    )
    return rows.withColumns(
        {
            f"alarm_pre_{TARGET}": (~few & ~many & outside).cast("int"),
            "retrain_required": (~few & many).cast("int"),
            "additional_records_needed": few.cast("int"),
            "next_retraining_qty": F.col("_next"),
            "minimum_train_records_qty": F.lit(min_records).cast("long"),
            "message": message,
        }
    ).drop("_n", "_next")


def next_training_size(known: Column, next_train: Column | int, step: int = 12) -> Column:
    """Row count that triggers the next training: moved on by `step` once reached."""
    next_train = next_train if isinstance(next_train, Column) else F.lit(next_train)
    return F.when(known >= next_train, known + step).otherwise(next_train)


def band_point_alarms(rows: DataFrame, ma: str, std: str, bands: DataFrame, sigma: float = 2.0) -> DataFrame:
    """Each predicted ma + sigma * std against the mean band (one row: spc_lower, spc_upper)."""
    packed = bands.select(F.struct("spc_lower", "spc_upper")).scalar()
    value = F.col(ma) + sigma * F.col(std)
    checked = rows.withColumns({"predicted": value, "_band": packed})
    outside = (F.col("predicted") < F.col("_band.spc_lower")) | (F.col("predicted") > F.col("_band.spc_upper"))
    return checked.withColumn("alarm", F.coalesce(outside, F.lit(False))).drop("_band")


def range_alarm(actual: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """Trend and alarm level of a limit pair against the +-20 % range of the actual value."""
    low, high = actual * 0.8, actual * 1.2
    cases = [
        ((lo < low) & (hi > high), "Within SPC limits", "No Alarm"),
        ((lo >= low) & (hi <= high), "Approaching SPC limits", "No Alarm"),
        (lo < low, "Below SPC limits", "Low Alarm"),
        (hi > high, "Above SPC limits", "High Alarm"),
    ]
    trend, alarm = F.lit("Unknown"), F.lit("Unknown")
    for case, name, level in reversed(cases):
        trend, alarm = F.when(case, name).otherwise(trend), F.when(case, level).otherwise(alarm)
    return trend, alarm


def status(alarms: DataFrame) -> DataFrame:
    """red / green for the latest alarm row, yellow when there is none. Always one row."""
    last = F.max_by(F.struct(f"alarm_pre_{TARGET}", "pred_year", "pred_week", "message"), F.struct("pred_year", "pred_week"))
    row = alarms.agg(last.alias("_last"))
    color = (
        F.when(F.col("_last").isNull(), F.lit("yellow"))
        .when(F.col(f"_last.alarm_pre_{TARGET}") != 0, F.lit("red"))
        .otherwise(F.lit("green"))
    )
    return row.select(color.alias("color"), "_last.pred_year", "_last.pred_week", "_last.message")


def trend_with_alarms(trend: DataFrame, alarms: DataFrame) -> DataFrame:
    """Trend rows beside the forecast made for their week; of several forecasts, that of the latest week."""
    values = [f"alarm_pre_{TARGET}", f"predicted_{TARGET}_calculate"]
    latest = F.max_by(F.struct(*values), F.struct("week", *values))
    foretold = alarms.groupBy(F.col("pred_year").alias("year"), F.col("pred_week").alias("_week")).agg(latest.alias("_last"))
    foretold = foretold.select("year", F.col("_week").alias("week"), *[F.col(f"_last.{v}") for v in values])
    return trend.join(foretold, ["year", "week"], "left")
