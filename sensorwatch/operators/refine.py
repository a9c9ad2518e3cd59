"""Clean-up of extracted rows, and the numeric model frame built from them."""

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.calendar import clock_seconds, day_first_date
from ..functions.text import lower_names, require_columns, strip_strings
from ..schemas import FEATURES, NOT_MODELLED, REFINED_COLUMNS


def drop_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL: Spark orders NaN above every number, which no rule here wants."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: F.nanvl(F.col(n), F.lit(None).cast("double")) for n in floats}) if floats else df


def passed(df: DataFrame, column: str = "pass_failed", value: str = "Pass") -> DataFrame:
    return df.filter(F.col(column) == value)


def refine(df: DataFrame, required=FEATURES, keep=REFINED_COLUMNS, strict_dates: bool = False) -> DataFrame:
    """Trim, keep passed tests that carry the required measurements, derive time and date, prune.

    Narrow transformations only, so it runs unchanged on a stream.
    """
    rows = drop_nan(strip_strings(lower_names(df)))
    rows = passed(rows).na.drop(subset=list(required))
    rows = rows.withColumn("test_time_sec", clock_seconds(F.col("test_time_min")))
    if isinstance(rows.schema["date"].dataType, T.StringType):
        rows = rows.withColumn("date", day_first_date(F.col("date"), strict_dates))
    rows = rows.withColumn("batchid", F.col("batchid").cast("long"))
    return require_columns(rows, keep).select(*keep)


def model_columns(df: DataFrame, also_drop=()) -> DataFrame:
    """Drop the columns the outlier model does not use."""
    return df.drop(*NOT_MODELLED, *also_drop)


def fill_missing(df: DataFrame, sentinel: float = -999) -> DataFrame:
    """Sentinel for every missing number."""
    return df.na.fill(sentinel)
