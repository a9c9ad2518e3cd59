"""A store of tests by day: text is trimmed and dates are parsed once, on arrival; every later extract reads typed columns of the years it asks for.

Layout: `tests/test_year=<year>/` holds the rows, dealt by month and sorted by date, so that row groups cover few days; `batch_years/` holds the pairs
of batch and year that occur. An extract of a configuration joins its batches with their years first; as the year is the partition column, Spark
prunes the partitions that hold none of these batches when it runs (dynamic partition pruning).

Rows whose date cannot be read are kept in the partition without a year, where an extract of the whole store finds them.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.calendar import day_first_date
from ..functions.text import lower_names, strip_strings

TEST_YEAR = "test_year"


@dataclass(frozen=True)
class DayStore:
    """A store at a path that driver and executors share."""

    path: str

    def append(self, tests: DataFrame) -> None:
        """Add tests with a text or typed `date`. Each year is written by as many tasks as its size asks for."""
        rows = strip_strings(lower_names(tests))
        if isinstance(rows.schema["date"].dataType, T.StringType):
            rows = rows.withColumn("date", day_first_date(F.col("date")))
        rows = rows.withColumn("date", F.col("date").cast("date")).withColumn(TEST_YEAR, F.year("date"))
        # Dealt by months, not by sampled ranges: the text is parsed once less, and large months are split, so that no sort outgrows its task.
        dealt = rows.withColumn("_month", F.month("date")).hint("rebalance", TEST_YEAR, "_month").sortWithinPartitions(TEST_YEAR, "date").drop("_month")
        dealt.write.mode("append").partitionBy(TEST_YEAR).parquet(f"{self.path}/tests")
        pairs = rows.select("batchid", TEST_YEAR).distinct().coalesce(8)
        pairs.write.mode("append").parquet(f"{self.path}/batch_years")

    def tests(self, spark: SparkSession) -> DataFrame:
        """The rows, with `test_year` as the partition column."""
        return spark.read.parquet(f"{self.path}/tests")

    def batch_years(self, spark: SparkSession) -> DataFrame:
        """One row for each batch and year; a pair that came in several times is one."""
        return spark.read.parquet(f"{self.path}/batch_years").distinct()
