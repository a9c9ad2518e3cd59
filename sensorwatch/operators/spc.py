"""Control charts: rolling bands, trend labels, alert counts, drift."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.calendar import sunday_ending
from ..functions.limits import parse_range
from .skew import MAX_GROUP_ROWS, HotGroups, attach, hot_groups, rolling

WINDOW_ROWS = 10
SIGMA = 2.0

# Labels of the trend rule and of the dashboard rule.
TREND_LABELS = {
    0: "0:Within SPC limits",
    1: "1:Approaching SPC limits",
    2: "2:Below SPC limits",
    3: "3:Above SPC limits",
    4: "4:Above limits",
    5: "5:Unknown",
}
ALERT_LABELS = ["Within SPC limits", "Approaching SPC limits", "Out of SPC limits", "Out of limits", "Within limits"]


def control_bands(df: DataFrame, features: Sequence[str], keys: Sequence[str], order: Sequence[str],
                  window: int = WINDOW_ROWS, sigma: float = SIGMA, max_group_rows: int = MAX_GROUP_ROWS,
                  hot: HotGroups | None = None) -> DataFrame:
    """Rolling mean, sample deviation and mean -+ sigma * deviation, for all features in one window."""
    aggregates = {}
    for f in features:
        aggregates[f"{f}_ma"] = F.avg(f)
        aggregates[f"{f}_std"] = F.stddev_samp(f)
    banded = rolling(df, aggregates, keys, order, window, max_group_rows, hot)
    bands = {}
    for f in features:
        bands[f"{f}_spc_lower"] = F.col(f"{f}_ma") - sigma * F.col(f"{f}_std")
        bands[f"{f}_spc_upper"] = F.col(f"{f}_ma") + sigma * F.col(f"{f}_std")
    return banded.withColumns(bands)


def chart_series(df: DataFrame, feature: str, keys: Sequence[str], order: Sequence[str], **options) -> DataFrame:
    """Value, moving average and both band lines of one feature."""
    banded = control_bands(df, [feature], keys, order, **options)
    lines = {"ma": "ma", "std": "std", "spc_lower": "spc_lower", "spc_upper": "spc_upper"}
    return banded.select(
        *keys, *[o for o in order if o not in keys], F.col(feature).alias("value"),
        *[F.col(f"{feature}_{line}").alias(name) for line, name in lines.items()],
    )


def first_limits(df: DataFrame, features: Sequence[str], keys: Sequence[str], order: Sequence[str],
                 policy: str = "open") -> DataFrame:
    """Limits of the first row of each group, in the given order."""
    place = F.struct(*order)
    firsts = [F.min_by(F.coalesce(f"{f}_limit", F.lit("")), place).alias(f) for f in features]
    grouped = df.groupBy(*keys).agg(*firsts)
    sides = []
    for f in features:
        limits = parse_range(F.col(f), policy)
        sides += [limits["lo"].alias(f"{f}_lo_limit"), limits["hi"].alias(f"{f}_hi_limit")]
    return grouped.select(*keys, *sides)


def mean_limits(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), policy: str = "zero") -> DataFrame:
    """Mean of the lower and of the upper limits of each group."""
    sides = []
    for f in features:
        limits = parse_range(F.col(f"{f}_limit"), policy)
        sides += [F.avg(limits["lo"]).alias(f"{f}_lo_limit"), F.avg(limits["hi"]).alias(f"{f}_hi_limit")]
    return df.groupBy(*keys).agg(*sides)


def band_summary(banded: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Range of the values and mean of the band lines per group, combined before the shuffle."""
    parts = []
    for f in features:
        parts += [
            F.min(f).alias(f"{f}_lo_value"),
            F.max(f).alias(f"{f}_hi_value"),
            F.avg(f"{f}_spc_lower").alias(f"{f}_lo_spc"),
            F.avg(f"{f}_spc_upper").alias(f"{f}_hi_spc"),
        ]
    return banded.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *parts)


def trend_label(lo_value: Column, hi_value: Column, lo_spc: Column, hi_spc: Column, lo_limit: Column,
                hi_limit: Column, rule: str = "compat") -> Column:
    """Label of a group. `compat` keeps the long-standing order of the checks, in which a value range
    wider than the band counts as within; `strict` names what the range does to the band and limits."""
    if rule == "compat":
        checks = [
            (0, (lo_value < lo_spc) & (hi_value > hi_spc)),
            (1, (lo_value * 1.1 >= lo_spc) | (hi_value * 0.9 <= hi_spc)),
            (2, lo_value > lo_spc),
            (3, hi_value > hi_spc),
            (4, (hi_value > hi_limit) | (lo_value < lo_limit)),
        ]
    elif rule == "strict":
        checks = [
            (4, (hi_value > hi_limit) | (lo_value < lo_limit)),
            (3, hi_value > hi_spc),
            (2, lo_value < lo_spc),
            (1, (lo_value <= lo_spc + F.abs(lo_spc) * 0.1) | (hi_value >= hi_spc - F.abs(hi_spc) * 0.1)),
            (0, (lo_value >= lo_spc) & (hi_value <= hi_spc)),
        ]
    else:
        raise ValueError(f"unknown rule: {rule}")
    label = F.lit(TREND_LABELS[5])
    for code, check in reversed(checks):
        label = F.when(check, F.lit(TREND_LABELS[code])).otherwise(label)
    return label


def alert_label(lo_value: Column, hi_value: Column, lo_spc: Column, hi_spc: Column, lo_limit: Column,
                hi_limit: Column) -> Column:
    """Dashboard label of a group; NULL when the band is missing."""
    narrower = (lo_value > lo_spc) | (hi_value < hi_spc)
    touches = (lo_value <= lo_spc) | (hi_value >= hi_spc)
    beyond = (lo_value < lo_limit) | (hi_value > hi_limit)
    close = (lo_value * 1.1 < lo_spc) | (hi_value * 0.9 > hi_spc)
    return (
        F.when(narrower & close, F.lit("Approaching SPC limits"))
        .when(narrower, F.lit("Within SPC limits"))
        .when(touches & beyond, F.lit("Out of limits"))
        .when(touches, F.lit("Within limits"))
    )


def _labels(summary: DataFrame, features: Sequence[str], label) -> DataFrame:
    parts = ["lo_value", "hi_value", "lo_spc", "hi_spc", "lo_limit", "hi_limit"]
    return summary.withColumns({f"{f}_alarm": label(*[F.col(f"{f}_{p}") for p in parts]) for f in features})


def by_feature(df: DataFrame, features: Sequence[str], parts: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per feature out of the wide form; a projection, without a shuffle."""
    entries = [
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value") if f in df.columns else
                 F.lit(None).cast("double").alias("value"), *[F.col(f"{f}_{p}").alias(p) for p in parts])
        for f in features
    ]
    return df.select(*keep, F.inline(F.array(*entries)))


def group_trends(df: DataFrame, limits: DataFrame, features: Sequence[str], keys: Sequence[str],
                 order: Sequence[str], rule: str = "compat", max_group_rows: int = MAX_GROUP_ROWS,
                 **options) -> DataFrame:
    """One row per group and feature: value range, mean band, limits and trend label."""
    summary = band_summary(control_bands(df, features, keys, order, max_group_rows=max_group_rows, **options), features, keys)
    labelled = _labels(attach(summary, limits, keys), features, lambda *a: trend_label(*a, rule=rule))
    parts = ["lo_value", "hi_value", "lo_spc", "hi_spc", "lo_limit", "hi_limit", "alarm"]
    return by_feature(labelled, features, parts, [*keys, "rows"]).drop("value")


def spc_trend(df: DataFrame, limits: DataFrame, features: Sequence[str], keys: Sequence[str], order: Sequence[str],
              rule: str = "compat", keep: Sequence[str] = (), max_group_rows: int = MAX_GROUP_ROWS, **options) -> DataFrame:
    """Rows with their bands and the label of their group, one row per feature.

    `limits` holds `<feature>_lo_limit` and `<feature>_hi_limit` per key. A feature whose limits are
    missing altogether under the open policy is left out, as a feature without a limit text has no trend.
    """
    needed = list(dict.fromkeys([*keys, *order, *features, *keep]))
    hot = hot_groups(df, keys, max_group_rows)
    banded = control_bands(df.select(*needed), features, keys, order, max_group_rows=max_group_rows, hot=hot, **options)
    summary = attach(band_summary(banded, features, keys), limits, keys)
    labels = _labels(summary, features, lambda *a: trend_label(*a, rule=rule)).select(
        *keys, *[f"{f}_alarm" for f in features],
        *[F.col(f"{f}_lo_limit").isNotNull().alias(f"{f}_limited") for f in features],
    )
    joined = attach(banded, labels, keys, hot, max_group_rows)
    kept = list(dict.fromkeys([*keys, *order, *keep]))
    rows = by_feature(joined, features, ["ma", "std", "spc_lower", "spc_upper", "alarm", "limited"], kept)
    return rows.filter("limited").drop("limited")


def alert_counts(df: DataFrame, value_range: DataFrame, limits: DataFrame, feature: str, keys: Sequence[str],
                 order: Sequence[str], **options) -> DataFrame:
    """Rows per dashboard label, zero-filled, and the true row total.

    Every row of a group carries the label of the group, so the counts follow from the group sizes.
    `value_range` holds `<feature>_lo_value` and `<feature>_hi_value` of the outliers.
    """
    bands = control_bands(df, [feature], keys, order, **options)
    summary = band_summary(bands, [feature], keys).drop(f"{feature}_lo_value", f"{feature}_hi_value")
    labelled = _labels(attach(attach(summary, value_range, keys), limits, keys), [feature], alert_label)
    alarm = F.col(f"{feature}_alarm")
    counts = [
        F.struct(F.lit(name).alias("label"), F.when(alarm == name, F.col("rows")).otherwise(F.lit(0)).alias("value"))
        for name in ALERT_LABELS
    ]
    return labelled.select(*keys, F.inline(F.array(*counts)), F.col("rows").alias("total"))


def weekly_moving_average(df: DataFrame, day: str, feature: str, weeks: int = 7) -> DataFrame:
    """Mean per week ending on Sunday, with empty weeks kept, and the mean of the last `weeks` weekly
    values (NULL until all are there). The ordered window runs over calendar weeks, not over rows."""
    weekly = df.filter(F.col(day).isNotNull()).groupBy(sunday_ending(F.col(day)).alias("week_end")).agg(F.avg(feature).alias("weekly_mean"))
    spine = weekly.agg(F.min("week_end").alias("first"), F.max("week_end").alias("last")).select(
        F.explode(F.sequence("first", "last", F.expr("interval 7 days"))).alias("week_end")
    )
    calendar = spine.join(weekly, "week_end", "left")
    last = Window.orderBy("week_end").rowsBetween(-(weeks - 1), 0)
    full = F.count("weekly_mean").over(last) == weeks
    return calendar.withColumn("moving_average", F.when(full, F.avg("weekly_mean").over(last)))


def drift(df: DataFrame, value: str, sequence: str, keys: Sequence[str], lo: float | Column, hi: float | Column) -> DataFrame:
    """Slope of the value over the sequence per group and how many steps remain until it meets the
    limit it moves toward (NULL when flat)."""
    fitted = df.groupBy(*keys).agg(
        F.regr_slope(F.col(value), F.col(sequence).cast("double")).alias("slope"),
        F.max_by(value, sequence).alias("last_value"),
        F.count(value).alias("rows"),
    )
    lo, hi = (F.lit(x) if not isinstance(x, Column) else x for x in (lo, hi))
    target = F.when(F.col("slope") > 0, hi).when(F.col("slope") < 0, lo)
    return fitted.withColumn("steps_to_limit", (target - F.col("last_value")) / F.nullif(F.col("slope"), F.lit(0.0)))


def rolling_drift(df: DataFrame, value: str, sequence: str, keys: Sequence[str], rows: int = 10, **options) -> DataFrame:
    """Slope over the last `rows` rows at every row."""
    slope = F.regr_slope(F.col(value), F.col(sequence).cast("double"))
    return rolling(df, {"slope": slope}, keys, [sequence], rows, **options)
