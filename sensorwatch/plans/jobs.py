"""The daily and weekly jobs, and the tables behind a dashboard."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import current_period
from ..operators import alarms, spc
from ..operators.encode import CategoryCodes
from ..operators.extract import extract
from ..operators.forecast import apply_model, boosted_model, load_model, save_model
from ..operators.forest import IsolationForest
from ..operators.guard import append_new_periods
from ..operators.rollup import lagged_weeks, latest, weekly_rollup
from ..schemas import ALARMS, CATEGORIES, FEATURES, NOT_MODELLED, REFINED_COLUMNS, TREND_BANDS, WEEKLY
from ..session import staged
from ..sources.files import path_exists, read_snapshot
from ..sources.messages import publish, to_messages

MEAN, SPREAD = "stitcharea_week_mean", "stitcharea_week_stddev"


def daily_ingest(tables: dict[str, DataFrame], as_of: date, history_year: int | None = None, config_id: int = 917,
                 **options) -> DataFrame:
    """Rows of the week that holds `as_of`, or of a whole past year."""
    period = current_period(as_of, history_year, options.get("week_rule", "server"))
    return extract(tables["batches"], tables["tests"], tables["cells"], tables["limits"], config_id, **period, **options)


def publish_ingest(rows: DataFrame, batch_id: str, options: dict[str, str], fmt: str = "kafka", path: str | None = None) -> None:
    publish(to_messages(rows, batch_id, ["testid", "batchid"]), options, fmt, path)


def score_rows(refined: DataFrame, row_id, seed: int, contamination: float = 0.05, trees: int = 100, number=None) -> tuple:
    """Model, category dictionary and the refined rows with score and label beside them.

    `number` makes the whole number that draws go by from the model's columns; without it, they are hashed with `row_id`.
    """
    codes = CategoryCodes.fit(refined, CATEGORIES)
    coded = codes.encode(refined, as_codes=False)
    modelled = [f"{c}_code" if c in CATEGORIES else c for c in REFINED_COLUMNS if c not in NOT_MODELLED]
    forest = IsolationForest(modelled, seed, contamination, trees)
    model, labelled = forest.fit_score(coded, row_id, number=number(modelled) if number else None)
    return model, codes, labelled


def outlier_trends(labelled: DataFrame, order, path: str | None = None, on_conflict: str = "skip_rows", rule: str = "compat") -> DataFrame:
    """Band rows and trend labels of the outliers per year and week; appended for new periods only."""
    keys = ["year", "week"]
    flagged = labelled.filter(F.col("outlier") == -1)
    limits = spc.first_limits(labelled, FEATURES, keys, order)
    trend = spc.spc_trend(flagged, limits, FEATURES, keys, order, rule)
    if path:
        append_new_periods(trend, path, ["feature", "year", "week"], on_conflict, ["feature", "year"])
    return trend


def weekly_history(refined: DataFrame, path: str, on_conflict: str = "skip_batch") -> None:
    append_new_periods(weekly_rollup(refined), path, ["year", "week"], on_conflict, ["year"])


def train_forecast(weekly: DataFrame, model_path: str, horizon: int = 1, seed: int = 42) -> None:
    """Boosted trees for the weekly mean and deviation; `horizon` weeks ahead, or of the same week (0).

    The history has one row a week, so it is put into one partition: each step of the training is then one small task.
    """
    targets = staged(lagged_weeks(weekly, [MEAN, SPREAD], horizon).coalesce(1), "weeks")
    for target in (MEAN, SPREAD):
        drop = [f"next_{t}" for t in (MEAN, SPREAD) if t != target] + ([target] if horizon == 0 else [])
        save_model(boosted_model(targets, f"next_{target}", f"pred_{target}", drop, seed), f"{model_path}/{target}")


def weekly_forecast(spark: SparkSession, history_path: str, trend_path: str, model_path: str, alarm_path: str,
                    min_records: int = 20, next_train: int = 130, horizon: int = 1, seed: int = 42) -> DataFrame:
    """Forecast the week after the latest one, set the alarm state, and append it once per target week.

    The model is trained when it is missing or the history has reached the size for the next training: that of the last alarm row, or
    `next_train` before the first one. Without a trend table there are no bands, and nothing lies outside of them.
    """
    weekly = read_snapshot(spark, history_path, WEEKLY)
    known = weekly.count()
    if known < min_records:
        return spark.createDataFrame([], ALARMS)
    log = read_snapshot(spark, alarm_path, ALARMS)
    last = latest(log.select("pred_year", "pred_week", "next_retraining_qty"), ["pred_year", "pred_week"]).first()
    next_train = last["next_retraining_qty"] if last and last["next_retraining_qty"] else next_train
    due = known >= next_train
    if due or not path_exists(spark, f"{model_path}/{SPREAD}/metadata"):
        train_forecast(weekly, model_path, horizon, seed)
    next_train = alarms.next_training_size(F.lit(known).cast("long"), next_train)
    current = latest(weekly, ["year", "week"])
    for target in (MEAN, SPREAD):
        current = apply_model(load_model(f"{model_path}/{target}"), current)
    trend = read_snapshot(spark, trend_path, TREND_BANDS)
    bands = alarms.weekly_bands(trend, "stitcharea")
    predicted = alarms.forecast_rows(current.select("year", "week", f"pred_{MEAN}", f"pred_{SPREAD}"), bands)
    state = alarms.alarm_state(predicted, F.lit(known), min_records, next_train)
    state = state.select(*[F.col(f.name).cast(f.dataType) for f in ALARMS.fields])
    append_new_periods(state, alarm_path, ["pred_year", "pred_week"])
    return state


def dashboard(labelled: DataFrame, refined: DataFrame, week: int, cells, feature: str, order, year: int | None = None) -> dict[str, DataFrame]:
    """Series, limits and label counts for one week (of one year, or of that number in all years) and a choice of cells."""
    chosen = labelled.filter((F.col("week") == week) & F.col("tp_cell_name").isin(list(cells)))
    chosen = chosen.filter(F.col("year") == year) if year else chosen
    flagged = labelled.filter(F.col("outlier") == -1)
    value_range = flagged.agg(F.min(feature).alias(f"{feature}_lo_value"), F.max(feature).alias(f"{feature}_hi_value"))
    limits = spc.mean_limits(refined, [feature])
    return {
        "series": spc.chart_series(chosen, feature, [], order),
        "limits": limits,
        "alerts": spc.alert_counts(chosen, value_range, limits, feature, [], order),
    }
