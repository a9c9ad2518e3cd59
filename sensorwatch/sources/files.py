"""Snapshot tables, legacy documents, CSV folders and managed tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from ..functions.text import name_positionally
from ..schemas import PAYLOAD_COLUMNS


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace the table at the path. Without dynamic partition overwrite, the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).format(fmt).save(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Add rows without reading what is there."""
    df.write.mode("append").partitionBy(*partition_by).format(fmt).save(path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", missing_ok: bool = True) -> DataFrame:
    """Scan with a declared schema. A path that does not exist is an empty table, or an error."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the `<name>=<number>` folders of a path, in order."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath().getName() for f in system.listStatus(root)] if system.exists(root) else []
    return sorted(int(f.split("=")[1]) for f in found if f.startswith(f"{name}="))


def drop_numbered(spark: SparkSession, path: str, name: str, keep_from: int) -> None:
    """Remove the `<name>=<number>` folders with smaller numbers."""
    for number in numbered(spark, path, name):
        if number < keep_from:
            gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}={number}")
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_column_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Import documents of the form {column: {index: value}}, one table per file.

    Files are read in parallel; a file becomes rows keyed by its index. Values are cast to the
    declared schema, and the file and index are kept as `source_file` and `source_index`. A file is one value, of 2 GB at
    most and better far less; `documents.read_column_documents_in_pieces` reads larger ones.
    """
    documents = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.from_json("value", "map<string, map<string, string>>").alias("document"),
    )
    columns = documents.select("source_file", F.explode("document").alias("column", "cells"))
    cells = columns.select("source_file", "column", F.explode("cells").alias("source_index", "cell"))
    wide = cells.groupBy("source_file", "source_index").pivot("column", schema.fieldNames()).agg(F.first("cell"))
    return wide.select(
        "source_file", F.col("source_index").cast("long").alias("source_index"),
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields],
    )


def read_station_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan a folder of `<station>_<lot>.csv` files. Files without rows add nothing."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/\\]+)\.[^.]+$", 1)
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.select(
        "*", F.regexp_extract(name, r"^(.*)_[^_]*$", 1).alias("station"), F.regexp_extract(name, r"_([^_]*)$", 1).alias("lot")
    )


def station_lots(rows: DataFrame) -> DataFrame:
    """Lots seen per station, one row each; not gathered into one value, as a station may have many."""
    return rows.select("station", "lot").distinct()


def read_payload(df: DataFrame, names: Sequence[str] = PAYLOAD_COLUMNS) -> DataFrame:
    return name_positionally(df, names)


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).format("parquet").saveAsTable(name)


def read_database(spark: SparkSession, table: str, options: dict[str, str], partition_column: str | None = None,
                  bounds: tuple[int, int] | None = None, partitions: int = 1) -> DataFrame:
    """A table over JDBC. All connection options come from the caller; a failed connection raises.

    With a partition column the table is read in parallel ranges; filters and pruning are pushed down.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions)
        )
    return reader.load()
