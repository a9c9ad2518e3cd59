"""Forecast models of weekly statistics and of the control bands."""

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement
from math import isfinite

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .skew import MAX_GROUP_ROWS, NO_GROUPS, HotGroups, attach, hot_groups

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SENTINEL = -999.0
BAND_FEATURES = ["week", "domecasegap", "stitcharea", "test_time_sec"]


def in_training(ident: Column, share: float = 0.8, seed: int = 42) -> Column:
    """Repeatable split by an integer id: the same rows under any partitioning."""
    return F.pmod(ident * 7919 + seed, F.lit(100)) < int(share * 100)


def split_rows(df: DataFrame, ident: str, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    chosen = in_training(F.col(ident), share, seed)
    return df.filter(chosen), df.filter(~chosen)


def holdout(df: DataFrame, ident: Sequence[str], share: float = 0.2, seed: int = 42, ticket: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Exactly int(share * n) rows in hash order, or in that of `ticket`, for validation; the remainder trains.

    Meant for period tables, which hold one row per calendar period.
    """
    n = int(share * df.count())
    ticket = F.xxhash64(*ident, F.lit(seed)) if ticket is None else ticket
    chosen = df.select(*ident).orderBy(ticket, *ident).limit(n)
    return df.join(chosen, list(ident), "left_anti"), df.join(chosen, list(ident), "left_semi")


def model_features(df: DataFrame, target: str, drop: Sequence[str] = ()) -> list[str]:
    """All numeric columns but the target and a drop list."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return [c for c in numeric if c != target and c not in drop]


def linear_model(df: DataFrame, target: str, features: Sequence[str], prediction: str) -> PipelineModel:
    """Least squares by the normal equations, summed on the executors, over the complete rows."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol=f"_{prediction}_x", handleInvalid="keep"),
        LinearRegression(
            featuresCol=f"_{prediction}_x", labelCol=target, predictionCol=prediction, solver="normal", regParam=0.0
        ),
    ]
    return Pipeline(stages=stages).fit(df.na.drop(subset=[target, *features]))


def boosted_model(df: DataFrame, target: str, prediction: str, drop: Sequence[str] = (), seed: int = 42,
                  iterations: int = 20, depth: int = 3) -> PipelineModel:
    """Boosted trees over all other numeric columns. A missing feature is the sentinel, in training and
    in prediction, so no period is left without a forecast."""
    features = model_features(df, target, drop)
    filled = ", ".join(f"coalesce(double(`{f}`), {SENTINEL}) AS `_{prediction}_{f}`" for f in features)
    stages = [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"_{prediction}_{f}" for f in features], outputCol=f"_{prediction}__vector"),
        GBTRegressor(
            featuresCol=f"_{prediction}__vector", labelCol=target, predictionCol=prediction, seed=seed, maxIter=iterations,
            maxDepth=depth,
        ),
    ]
    return Pipeline(stages=stages).fit(df.na.drop(subset=[target]))


@dataclass
class HeldOutFit:
    """A model cut at the iteration with the smallest held-out error, and the errors of all iterations tried."""

    model: PipelineModel
    best: int
    errors: list[tuple[int, float, float]]

    def log(self, spark: SparkSession) -> DataFrame:
        """iteration (from 1), learn, test: root mean squared errors on the training and the held-out rows."""
        return spark.createDataFrame(self.errors, "iteration int, learn double, test double")


def boosted_with_holdout(train: DataFrame, held_out: DataFrame, target: str, prediction: str, drop: Sequence[str] = (), seed: int = 42,
                         iterations: int = 20, depth: int = 3) -> HeldOutFit:
    """Boosted trees that stop where the held-out error is smallest (the earliest of equal ones).

    All iterations are fitted and logged; as a tree depends on the ones before it only, the model with fewer iterations is the
    same model cut. Without complete held-out rows nothing is cut.
    """
    whole = boosted_model(train, target, prediction, drop, seed, iterations, depth)
    prepare = PipelineModel(whole.stages[:-1])
    frames = [prepare.transform(df.na.drop(subset=[target])) for df in (train, held_out)]
    learn, test = ([float("nan")] * iterations if f.isEmpty() else [e**0.5 for e in whole.stages[-1].evaluateEachIteration(f, "squared")] for f in frames)
    errors = [(i, a, b) for i, (a, b) in enumerate(zip(learn, test), 1)]
    best = min(errors, key=lambda e: (e[2], e[0]))[0] if all(isfinite(e) for e in test) else iterations
    model = whole if best == iterations else boosted_model(train, target, prediction, drop, seed, best, depth)
    return HeldOutFit(model, best, errors)


def apply_model(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the prediction column; NULL where a linear model misses a feature."""
    name = model.stages[-1].getPredictionCol()
    predicted = model.transform(df)
    helpers = [c for c in predicted.columns if c.startswith(f"_{name}_")]
    return predicted.drop(*helpers).withColumn(name, F.nanvl(F.col(name), F.lit(None).cast("double")))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def mean_squared_error(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.pow(F.col(actual) - F.col(predicted), 2)).alias("mse"))


def residual_summary(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Count, mean, deviation and extremes of the residuals, and the share of variance explained."""
    rest = F.col(actual) - F.col(predicted)
    return df.agg(
        F.count(rest).alias("rows"), F.avg(rest).alias("mean"), F.stddev_samp(rest).alias("stddev"),
        F.min(rest).alias("lowest"), F.max(rest).alias("highest"),
        (1 - F.avg(F.pow(rest, 2)) / F.var_pop(actual)).alias("r2"),
    )


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Importance of each feature as rows; one row per model column."""
    prefix = f"_{model.stages[-1].getPredictionCol()}_"
    names = [c.removeprefix(prefix) for c in model.stages[-2].getInputCols()]
    values = model.stages[-1].featureImportances.toArray()
    return df.sparkSession.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )


def _centred_solve(products: pd.Series, cross: pd.Series) -> pd.Series:
    """Minimum-norm least squares for a batch of groups from their centred second moments."""
    right = np.array(cross.tolist(), dtype=float)
    width = right.shape[1]
    left = np.zeros((len(right), width, width))
    flat = np.array(products.tolist(), dtype=float)
    for at, (i, j) in enumerate(combinations_with_replacement(range(width), 2)):
        left[:, i, j] = left[:, j, i] = flat[:, at]
    weights = np.linalg.pinv(left, rcond=1e-12, hermitian=True) @ right[:, :, None]
    return pd.Series(list(weights[:, :, 0]))


def grouped_linear_fit(df: DataFrame, target: str, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One regression per group: coefficients (in feature order), intercept and row count.

    A group is reduced to its means and covariances by a map-side combined aggregate, so a group of
    any size reaches the solver as one row. Constant features get coefficient 0.
    """
    used = df.na.drop(subset=[target, *features])
    pairs = list(combinations_with_replacement(features, 2))
    moments = used.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(target).alias("_y"),
        F.array(*[F.avg(f) for f in features]).alias("_means"),
        F.array(*[F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")) for a, b in pairs]).alias("_products"),
        F.array(*[F.covar_pop(F.col(f).cast("double"), F.col(target).cast("double")) for f in features]).alias("_cross"),
    )
    solve = F.pandas_udf(_centred_solve, "array<double>")
    solved = moments.withColumn("coefficients", solve("_products", "_cross"))
    weighted = F.zip_with("coefficients", "_means", lambda w, m: w * m)
    intercept = F.col("_y") - F.aggregate(weighted, F.lit(0.0), lambda total, x: total + x)
    return solved.select(*keys, "rows", "coefficients", intercept.alias("intercept"))


def grouped_predict(df: DataFrame, fits: DataFrame, features: Sequence[str], keys: Sequence[str], prediction: str,
                    max_group_rows: int = MAX_GROUP_ROWS, hot: HotGroups | None = None) -> DataFrame:
    """Apply the fit of each row's group; the fits are one row per group. `hot` names hot groups already known."""
    hot = hot_groups(df, keys, max_group_rows) if hot is None else hot
    parts = fits.select(*keys, F.col("coefficients").alias("_w"), F.col("intercept").alias("_b"))
    joined = attach(df, parts, keys, hot, max_group_rows)
    value = F.col("_b")
    for i, f in enumerate(features):
        value = value + F.col("_w")[i] * F.col(f)
    return joined.withColumn(prediction, value).drop("_w", "_b")


def holdout_errors(df: DataFrame, target: str, features: Sequence[str], keys: Sequence[str], ident: str, more_than: int = 20) -> DataFrame:
    """Per group: a regression on its training rows and the mean squared error on its other rows.

    Nothing is fitted unless there are more than `more_than` groups. The split is repeatable, by `ident`.
    """
    train, test = split_rows(df.na.drop(subset=[target, *features]), ident)
    enough = df.select(*keys).distinct().agg(F.count(F.lit(1)) > more_than).scalar()
    fits = grouped_linear_fit(train, target, features, keys).filter(enough)
    predicted = grouped_predict(test, fits, features, keys, "_predicted", hot=NO_GROUPS)
    return mean_squared_error(predicted, target, "_predicted", keys)


def level_alarms(train: DataFrame, df: DataFrame, levels: Mapping[str, float], features: Sequence[str] = tuple(BAND_FEATURES)) -> DataFrame:
    """`pred_<target>` and `<target>_alarm` (prediction above the level) for any number of targets, each with a linear model of its own."""
    for target, level in levels.items():
        df = apply_model(linear_model(train, target, features, f"pred_{target}"), df)
        df = df.withColumn(f"{target}_alarm", F.col(f"pred_{target}") > level)
    return df
