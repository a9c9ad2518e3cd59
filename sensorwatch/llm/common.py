"""Helpers of the text operators: the shared folder, ASCII word handling, shingles and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word and line rules: space, and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset and the master local, as in tests, one made for the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="sensorwatch-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """df written to the shared folder and read back: computed once, and safe from lost executors. options: of the writer."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows with columns that are computed once for each row: a generator's output is not copied into the filters and expressions above it."""
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def ascii_lower(column: Column) -> Column:
    """A-Z lowered, all other characters kept."""
    return F.translate(column, UPPER, LOWER)


def text_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that what is made from long texts stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_list(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lowered. Byte strings split and lower by just these ASCII rules."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of `size` words; of the whole sequence when there are fewer; none without words."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = mixed(out * _ODD + hashes[k : k + n])
    return out


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of the undirected links reaches.

    Large-star and small-star rounds, each an aggregate and a join by node: a hub of any degree
    is pre-aggregated, and its join rows are spread by Spark's skew handling (which wants a shuffle right below the join, hence the hint). Rounds end when the links no longer change.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, mark = _marked(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")).hint("rebalance")
        # Each node hands its smallest neighbour to its larger neighbours.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low")).hint("rebalance")
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "low"), F.struct(F.col("v").alias("u"), "low"))).alias("e"))
        edges, after = _marked(small.select("e.u", F.col("e.low").alias("v")).where("u <> v").distinct())
        if after == mark:
            break
        mark = after
    nodes = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Staged edges with their number and a checksum."""
    edges = staged(edges, "edges")
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return edges, (row[0], row[1])
