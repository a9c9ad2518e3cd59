"""Roll-ups by calendar period, and their use as history."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import following_week
from ..schemas import FEATURES


def weekly_rollup(df: DataFrame, features: Sequence[str] = FEATURES, keys: Sequence[str] = ("year", "week")) -> DataFrame:
    """Maximum, minimum, mean and sample deviation per period, combined before the shuffle."""
    parts = []
    for f in features:
        parts += [
            F.max(f).alias(f"maximum_{f}"),
            F.min(f).alias(f"minimum_{f}"),
            F.avg(f).alias(f"{f}_week_mean"),
            F.stddev_samp(f).alias(f"{f}_week_stddev"),
        ]
    return df.groupBy(*keys).agg(*parts)


def period_rollup(df: DataFrame, day: str, features: Sequence[str], unit: str = "week", keys: Sequence[str] = ()) -> DataFrame:
    """The same statistics per day, week, month, quarter or year start."""
    dated = df.withColumn("period", F.date_trunc(unit, F.col(day)).cast("date"))
    return weekly_rollup(dated, features, [*keys, "period"])


def weekly_profile(df: DataFrame, year: int, current_year: int, current_week: int,
                   features: Sequence[str] = (*FEATURES, "test_time_sec")) -> DataFrame:
    """Weekly means of a year (all its weeks, or up to now for the current year), followed by the weeks
    of the current year when the asked year has passed."""
    wanted = F.col("year") == year
    if year >= current_year:
        wanted = wanted & F.col("week").between(1, current_week)
    else:
        wanted = wanted | ((F.col("year") == current_year) & F.col("week").between(1, current_week))
    return df.filter(wanted).groupBy("year", "week").agg(*[F.avg(f).alias(f) for f in features])


def groups_with_rows(df: DataFrame, keys: Sequence[str], at_least: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") >= at_least)


def first_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], at_least: int, limit: int) -> DataFrame:
    """The first groups, in order of appearance, that have enough rows."""
    seen = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct(*order)).alias("_first"))
    return seen.filter(F.col("rows") >= at_least).orderBy("_first").limit(limit).drop("_first")


def latest(df: DataFrame, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The last row of each group; an aggregate, so nothing is sorted."""
    row = F.max_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*").filter(F.col(order[0]).isNotNull())


def first_rows(df: DataFrame, order: str, n: int) -> tuple[DataFrame, DataFrame]:
    """The first n rows by a unique order column, and the rest. Only n order values are sorted."""
    head = df.select(order).orderBy(order).limit(n)
    cut = head.agg(F.max(order)).scalar()
    return df.filter(F.col(order) <= cut), df.filter(F.col(order) > cut)


def append_frames(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def outliers_first(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Outliers (-1), then normals, each in order. A union would not keep any order."""
    return df.orderBy("outlier", *order)


def slice_rows(df: DataFrame, week: Column | int, cells: Sequence[float]) -> DataFrame:
    return df.filter((F.col("week") == week) & F.col("tp_cell_name").isin(list(cells)))


def lagged_weeks(weekly: DataFrame, targets: Sequence[str], horizon: int = 1, week_rule: str = "server") -> DataFrame:
    """Targets of the week that comes `horizon` calendar weeks later as `next_<target>`; NULL when it has no row."""
    year, week = F.col("year"), F.col("week")
    for _ in range(horizon):
        year, week = following_week(year, week, week_rule)
    later = weekly.select(F.col("year").alias("_year"), F.col("week").alias("_week"), *[F.col(t).alias(f"next_{t}") for t in targets])
    ahead = weekly.withColumns({"_year": year.cast("int"), "_week": week.cast("int")})
    return ahead.join(later, ["_year", "_week"], "left").drop("_year", "_week")
