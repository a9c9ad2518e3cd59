"""Thresholds: learned from history, set by users, and checked against rows.

Thresholds over past periods come from sketches that are kept beside the weekly history: one row for each key and week holds a mergeable quantile
sketch (KLL) of each feature. A threshold over any run of weeks merges these rows and reads no measurement. Up to SKETCH_SIZE values a merged
sketch keeps all of them and is exact; beyond, the rank of a threshold is off by `rank_error` at most (in 99 of 100 cases), whatever the number of values
and of merges. `percentile_thresholds` stays as the exact form over raw rows.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.limits import limit_zone
from .guard import append_new_periods
from .skew import MAX_GROUP_ROWS, NO_GROUPS, attach, exact_quantiles, hot_groups


def sigma_thresholds(df: DataFrame, value: str, keys: Sequence[str], k: float = 3.0) -> DataFrame:
    """mean -+ k * deviation over past rows."""
    mean, spread = F.avg(value), F.stddev_samp(value)
    return df.groupBy(*keys).agg((mean - k * spread).alias("lo_limit"), (mean + k * spread).alias("hi_limit"))


def percentile_thresholds(df: DataFrame, value: str, keys: Sequence[str], low: float = 0.01, high: float = 0.99,
                          max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    return exact_quantiles(df, value, {"lo_limit": low, "hi_limit": high}, keys, max_group_rows)


SKETCH_SIZE = 2_000


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Largest distance of a sketch's rank from the true one as a share of all values, at 99 % confidence: the published fit for KLL."""
    return 2.296 / size**0.9021


def period_sketches(df: DataFrame, features: Sequence[str], keys: Sequence[str], periods: Sequence[str] = ("year", "week"),
                    size: int = SKETCH_SIZE) -> DataFrame:
    """keys, periods, `<feature>_sketch` for each feature. Sketches are made before the shuffle and merged after it; missing values and NaN do not enter."""
    value = lambda f: F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))
    return df.groupBy(*keys, *periods).agg(*[F.kll_sketch_agg_double(value(f), size).alias(f"{f}_sketch") for f in features])


def sketch_history(df: DataFrame, path: str, features: Sequence[str], keys: Sequence[str], on_conflict: str = "skip_batch") -> None:
    """Append the sketches of new weeks to the table beside the weekly history."""
    append_new_periods(period_sketches(df, features, keys), path, ["year", "week"], on_conflict, ["year"])


def merged_thresholds(sketches: DataFrame, feature: str, keys: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """keys, lo_limit, hi_limit, rows over all periods of `sketches`. A limit is a value that occurs: the first one whose rank reaches the level.

    Choose the periods by a filter before. Keys without any value have no limits.
    """
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double(f"{feature}_sketch").alias("_s"))
    counted = merged.withColumn("rows", F.kll_sketch_get_n_double("_s")).filter(F.col("rows") > 0)
    at = lambda level: F.kll_sketch_get_quantile_double("_s", F.lit(level).cast("double"))
    return counted.select(*keys, at(low).alias("lo_limit"), at(high).alias("hi_limit"), "rows")


def with_thresholds(rows: DataFrame, thresholds: DataFrame, keys: Sequence[str], default: Mapping[str, float] | None = None,
                    max_group_rows: int = MAX_GROUP_ROWS, check_skew: bool = True) -> DataFrame:
    """Thresholds by key; rows without one get the default, if any."""
    hot = hot_groups(rows, keys, max_group_rows) if check_skew else NO_GROUPS
    joined = attach(rows, thresholds.select(*keys, "lo_limit", "hi_limit"), keys, hot, max_group_rows, "left")
    if default:
        joined = joined.na.fill(dict(default))
    return joined


def check_limits(rows: DataFrame, value: str, margin: float = 0.1) -> DataFrame:
    """Zone of each value: below, above, near or inside."""
    zone = limit_zone(F.col(value), F.col("lo_limit"), F.col("hi_limit"), margin)
    return rows.withColumn("zone", zone)


def limit_alerts(rows: DataFrame, value: str, margin: float = 0.1) -> DataFrame:
    return check_limits(rows, value, margin).filter(F.col("zone") != "inside")
