"""Measurement extract: batches, tests and cells joined with their limits."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import calendar
from ..functions.limits import range_text
from ..functions.text import lower_names, strip_strings
from ..schemas import MEASUREMENTS
from ..session import split_large_joins
from ..sources.daystore import TEST_YEAR, DayStore
from .skew import MAX_GROUP_ROWS, NO_GROUPS, HotGroups, attach, row_hash


def join_measurements(batches: DataFrame, tests: DataFrame, cells: DataFrame,
                      max_group_rows: int = MAX_GROUP_ROWS, hot: Mapping[str, HotGroups] | None = None,
                      batch_keys: Sequence[str] = ("batchid",)) -> DataFrame:
    """batches x tests on batchid (and further keys), x cells on testid. Name clashes keep the test's own column as tp_*.

    Hot keys are split by adaptive execution; `hot` names keys to salt beforehand.
    """
    clashes = [c for c in tests.columns if c in batches.columns and c not in batch_keys]
    tests = tests.withColumnsRenamed({c: f"tp_{c}" for c in clashes})
    hot = hot or {}
    if not any(hot.values()):
        return attach(attach(tests, batches, list(batch_keys)), cells, ["testid"])
    # One hash of the test serves both joins: one of the joined row would carry all columns through the first.
    tests = tests.withColumn("_spread", row_hash(tests))
    joined = attach(tests, batches, list(batch_keys), hot.get("batchid", NO_GROUPS), max_group_rows, spread="_spread")
    return attach(joined, cells, ["testid"], hot.get("testid", NO_GROUPS), max_group_rows, spread="_spread").drop("_spread")


def with_limits(rows: DataFrame, limits: DataFrame, key: str = "batchid", how: str = "inner",
                max_group_rows: int = MAX_GROUP_ROWS, hot: HotGroups | None = None) -> DataFrame:
    """Limits of each row as `<measurement>_limit`. Several limit rows per key repeat the row."""
    renamed = limits.withColumnsRenamed({c: f"{c}_limit" for c in limits.columns if c != key})
    return attach(rows, renamed, [key], hot or NO_GROUPS, max_group_rows, how)


def with_spc_ranges(rows: DataFrame, measurements=MEASUREMENTS) -> DataFrame:
    """Copies (`*_spc_orig`) and +-20 % ranges (`*_spc`) of the measurements."""
    present = [m for m in measurements if m in rows.columns]
    return rows.withColumns(
        {f"{m}_spc_orig": F.col(m) for m in present} | {f"{m}_spc": range_text(F.col(m)) for m in present}
    )


def _with_test_day(tests: DataFrame) -> DataFrame:
    """Add `_day`. Text is parsed in a generator, which the optimiser does not copy into every filter and
    calendar part that uses the day; a typed date stays a plain column, so filters reach the scan."""
    if isinstance(tests.schema["date"].dataType, T.StringType):
        parsed = F.struct(calendar.day_first_date(F.col("date")).alias("_day"))
        return tests.select("*", F.inline(F.array(parsed)))
    return tests.withColumn("_day", F.col("date").cast("date"))


def extract(batches: DataFrame, tests: DataFrame | DayStore, cells: DataFrame, limits: DataFrame, config_id=None,
            year=None, quarter=None, month=None, yearweek=None, weekday=None, week_rule: str = "server",
            limit_key: str = "batchid") -> DataFrame:
    """Tests of one configuration and period with ranges, limits and calendar parts.

    Text is trimmed before the joins, where each value is still stored once. The configuration filter reaches the batch scan. The period filter is applied to the tests
    before any join; over a typed date column its days also become a plain range for the scan. A day store reads the partitions of the period's years, and of the years of
    the configuration's batches, and parses nothing. Large partitions of the joins are split, which is set for the session.
    """
    split_large_joins(batches.sparkSession)
    period = dict(year=year, quarter=quarter, month=month, yearweek=yearweek, weekday=weekday)
    batches, cells, limits = (strip_strings(lower_names(t)) for t in (batches, cells, limits))
    if config_id is not None:
        batches = batches.filter(F.col("configid") == config_id)
    batch_keys = ["batchid"]
    if stored := isinstance(tests, DayStore):
        if config_id is not None:
            batch_keys = ["batchid", TEST_YEAR]
            batches = batches.join(tests.batch_years(batches.sparkSession), "batchid")
        tests = tests.tests(batches.sparkSession)
    else:
        tests = strip_strings(lower_names(tests))
    days = calendar.period_days(**period, week_rule=week_rule)
    if days and not isinstance(tests.schema["date"].dataType, T.StringType):
        if stored:
            tests = tests.filter(F.col(TEST_YEAR).between(days[0].year, days[1].year))
        tests = tests.filter(F.col("date").between(*(F.lit(d) for d in days)))
    tests = calendar.with_calendar_parts(_with_test_day(tests), F.col("_day"), week_rule).drop("_day")
    tests = tests.filter(calendar.period_predicate(**period))
    rows = join_measurements(batches, tests, cells, batch_keys=batch_keys)
    rows = rows.drop(TEST_YEAR) if stored else rows
    return with_limits(with_spc_ranges(rows), limits, limit_key)
