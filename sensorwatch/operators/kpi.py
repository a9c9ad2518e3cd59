"""Key figures of the outlier share and of the class means."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.limits import parse_range
from ..functions.text import fixed_text, percent_text

FLAGGED = -1


def _class_figures(feature: str, flag: str = "outlier") -> dict[str, Column]:
    bad, good = F.col(flag) == FLAGGED, F.col(flag) != FLAGGED
    return {
        "_bad": F.count_if(bad),
        "_good": F.count_if(good),
        "_bad_mean": F.avg(F.when(bad, F.col(feature))),
        "_good_mean": F.avg(F.when(good, F.col(feature))),
    }


def outlier_kpi(df: DataFrame, feature: str, limit: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Outlier share (against normals + 1), count, class means and mean limits, one row per key."""
    sides = parse_range(F.col(limit or f"{feature}_limit"), "skip")
    figures = {**_class_figures(feature), "_lo": F.avg(sides["lo"]), "_hi": F.avg(sides["hi"])}
    counted = df.groupBy(*keys).agg(*[c.alias(n) for n, c in figures.items()])
    return counted.select(
        *keys,
        F.lit(feature).alias("feature"),
        percent_text(F.col("_bad") / (F.col("_good") + 1)).alias("outlier_vs_normal"),
        F.col("_bad").alias("outlier_count"),
        fixed_text(F.col("_bad_mean")).alias("mean_outlier_feature"),
        fixed_text(F.col("_good_mean")).alias("mean_normal_feature"),
        F.struct(
            F.coalesce("_lo", F.lit(0.0)).alias("lo_avg"), F.coalesce("_hi", F.lit(0.0)).alias("hi_avg")
        ).alias("limit_feature"),
    )


def outlier_evaluation(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Outlier to normal ratio (NULL without normals), count, class mean and ratio of the means per
    feature, from one pass over the rows."""
    figures = {f"{f}{n}": c for f in features for n, c in _class_figures(f).items()}
    counted = df.groupBy(*keys).agg(*[c.alias(n) for n, c in figures.items()])
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.try_divide(F.col(f"{f}_bad"), F.col(f"{f}_good")).alias("ratio"),
            F.col(f"{f}_bad").alias("amount"),
            F.col(f"{f}_bad_mean").alias("mean_outlier"),
            F.col(f"{f}_good_mean").alias("mean_normal"),
            F.try_divide(F.col(f"{f}_bad_mean"), F.col(f"{f}_good_mean")).alias("mean_ratio"),
        )
        for f in features
    ]
    return counted.select(*keys, F.inline(F.array(*entries)))
