"""Category codes: position of a value among the sorted distinct values of its column."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import staged
from .skew import MAX_GROUP_ROWS, attach, hot_groups

#: Bytes of a column's values and codes up to which they are broadcast.
BROADCAST_BYTES = 16 << 20


def _entry(df: DataFrame, name: str) -> Column:
    """(column, number, text): numbers sort as numbers, text as text. Numbers that share a double, as large
    whole numbers do, are told apart and ordered by their text, padded to one width."""
    is_number = isinstance(df.schema[name].dataType, T.NumericType)
    number = F.col(name).cast("double") if is_number else F.lit(None).cast("double")
    text = _exact_text(df, name) if is_number else F.col(name).cast("string")
    return F.struct(F.lit(name).alias("column"), number.alias("number"), text.alias("text"))


def _exact_text(df: DataFrame, name: str) -> Column:
    """Empty for doubles and floats. Else the distance of a number from its double, padded so that it sorts."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.lit("")
    exact = F.col(name).cast("decimal(38,10)")
    gap = exact - F.col(name).cast("double").cast("decimal(38,10)")
    return F.lpad((gap + F.lit(10**12)).cast("string"), 40, "0")


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-missing values of all columns in one pass, combined before the shuffle."""
    entries = F.array(*[F.when(F.col(c).isNotNull(), _entry(df, c)) for c in columns])
    return df.select(F.explode(entries).alias("e")).filter("e is not null").select("e.*").distinct()


def number_categories(values: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Codes 0.. in sorted order per column.

    When a column has very many values, all of them are ranged by column and value at sampled bounds, which a row finds by bisection; a code is
    then the number of values in earlier ranges plus the position within the range. The ranges are written, so that every plan sees the same.
    """
    order = ["number", "text"]
    sizes = [r["count"] for r in values.groupBy("column").count().collect()]
    if max(sizes, default=0) <= max_group_rows:
        per_column = Window.partitionBy("column").orderBy(*order)
        return values.select("*", (F.row_number().over(per_column) - 1).cast("int").alias("code"))

    parts = -(-2 * sum(sizes) // max_group_rows)
    ranged = values.repartitionByRange(parts, "column", *order).withColumn("_part", F.spark_partition_id())
    ranged = staged(ranged, "ranges")
    totals = ranged.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("column", "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("column", "_part").orderBy(*order))
    coded = ranged.withColumn("_place", place).join(offsets, ["column", "_part"])
    return coded.select("column", *order, (F.col("_offset") + F.col("_place") - 1).cast("int").alias("code"))


@dataclass
class CategoryCodes:
    """A fitted dictionary. Kept with a stored model so that codes do not shift between batches."""

    dictionary: DataFrame
    sizes: dict[str, int]
    """Bytes by column: 20 for number and code, and those of the text."""

    @classmethod
    def of(cls, dictionary: DataFrame) -> "CategoryCodes":
        held = F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 20).alias("bytes")
        sizes = dictionary.groupBy("column").agg(held).orderBy("column").collect()
        return cls(dictionary, {r["column"]: r["bytes"] for r in sizes})

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], max_group_rows: int = MAX_GROUP_ROWS) -> "CategoryCodes":
        values = staged(category_values(df, columns), "categories")
        codes = cls.of(staged(number_categories(values, max_group_rows), "codes"))
        codes.sizes = {c: codes.sizes.get(c, 0) for c in columns}
        return codes

    def encode(self, df: DataFrame, as_codes: bool = True, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
        """Replace each column by its code (or add `<column>_code`). Missing and unseen values are -1.

        A column whose values are few bytes is joined by broadcast; the size is known from the dictionary. One
        with more is joined by shuffle, with its hot values spread over salts.
        """
        for name, size in self.sizes.items():
            is_number = isinstance(df.schema[name].dataType, T.NumericType)
            match = {"_number": "number", "_text": "text"} if is_number else {"_text": "text"}
            own = self.dictionary.filter(F.col("column") == name)
            codes = own.select(*[F.col(c).alias(n) for n, c in match.items()], F.col("code").alias("_code"))
            entry = _entry(df, name)
            valued = df.withColumns({n: F.when(F.col(name).isNotNull(), entry[c]) for n, c in match.items()})
            if size <= BROADCAST_BYTES or df.isStreaming:
                joined = valued.join(F.broadcast(codes) if size <= BROADCAST_BYTES else codes, list(match), "left")
            else:
                hot = hot_groups(valued, list(match), max_group_rows)
                joined = attach(valued, codes, list(match), hot, max_group_rows, "left")
            target = name if as_codes else f"{name}_code"
            df = joined.withColumn(target, F.coalesce("_code", F.lit(-1)).cast("int")).drop("_code", *match)
        return df

    def save(self, path: str) -> None:
        self.dictionary.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "CategoryCodes":
        return cls.of(spark.read.parquet(path))
