"""Nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector; the nearest of the 2d signed axes is
its bucket. Each of `tables` rotations makes one table. A query probes, in each table, the buckets of its `probes` largest signed coordinates;
every vector found there is scored by its exact cosine on the original values, in double precision.

Buckets are compared in blocks (`blocks.py`): a bucket of any size is cut into chunks, a task holds two of them, and hands on only the nearest of each block.
Equal vectors form one class with one entry in the index, led by its smallest id; a window with a pushed-down group limit keeps the
first few ids of a class, as many as a query can need. So a vector held by a third of all rows fills no bucket.

Defined cases: vectors that are null, zero, hold null or non-finite components, or have another length than most, take no part, as queries or
candidates; so do rows with a null id. Repeated rows with one id are one candidate. Equal scores are ordered by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorwatch.llm.blocks import groups, in_blocks
from sensorwatch.llm.common import staged

TABLES, PROBES, BLOCK = 8, 8, 4096


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, table: int) -> np.ndarray:
    """The signed coordinates (x, -x) of unit rows after the table's pseudo-rotation."""
    n = 1 << max(1, int(np.ceil(np.log2(x.shape[1]))))
    signs = np.random.default_rng(table + 1)
    x = np.pad(x, ((0, 0), (0, n - x.shape[1])))
    for _ in range(3):
        x = hadamard(x * signs.choice([-1.0, 1.0], n))
    return np.concatenate([x, -x], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _buckets(tables: int, probes: int):
    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            for table in range(tables):
                axes = rotated(x, table)
                near = np.argpartition(-axes, probes - 1, axis=1)[:, :probes] if probes < axes.shape[1] else np.tile(np.arange(axes.shape[1]), (len(x), 1))
                keys = (table * axes.shape[1] + near).astype(np.int64).reshape(-1)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(batch.column(0).to_numpy(), near.shape[1]))], names=["key", "id"])

    return buckets


def _score(k: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each query of a block, its k nearest classes of the block; more where the last one ties."""
        for table in groups(batches):
            side, ids = table.column("side").to_numpy(), table.column("id").to_numpy()
            x = _matrix(table.column("vector").combine_chunks())
            norm = np.linalg.norm(x, axis=1)
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            cosine = (x[left] @ x[right].T) / (norm[left][:, None] * norm[right][None, :])
            kth = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k] if k < len(right) else np.full((len(left), 1), -2.0)
            a, b = np.nonzero(cosine >= kth - 1e-12)
            yield pa.RecordBatch.from_arrays([pa.array(ids[left[a]]), pa.array(ids[right[b]])], names=["query", "class"])

    return score


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector of doubles) of the rows that take part."""
    vector = F.transform(vector_col, lambda x: x.cast("double"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), sound.alias("sound"))
    rows = rows.where("sound").where(F.exists("vector", lambda x: x != 0)).drop("sound")
    width = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    return rows.where(F.size("vector") == (width[0] if width else 0))


def nearest(
    rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, probes: int = PROBES
) -> DataFrame:
    """query_id, rank, id and score of the k nearest other rows of each row that is_query (a condition on `id`) names."""
    found = valid_vectors(rows, id_col, vector_col).dropDuplicates(["id"])
    found = staged(found, "vectors")
    lead = found.groupBy("vector").agg(F.min("id").alias("class"))
    classes = staged(lead.select(F.col("class").alias("id"), "vector"), "classes")
    member = found.join(lead, "vector").select("id", "class")
    # A query can need k candidates of a class besides itself.
    order = F.row_number().over(Window.partitionBy("class").orderBy("id"))
    first = staged(member.withColumn("n", order).where(F.col("n") <= k + 1).select("class", F.col("id").alias("candidate")), "members")
    queries = staged(found.where(is_query).select("id", "vector"), "queries")
    index = classes.mapInArrow(_buckets(tables, 1), "key long, id long")
    probed = queries.mapInArrow(_buckets(tables, probes), "key long, id long")
    payload = queries.withColumn("side", F.lit(0)).unionByName(classes.withColumn("side", F.lit(1)))
    blocks = in_blocks(probed, index, BLOCK, payload)
    near = blocks.mapInArrow(_score(k + 1), "query long, class long").distinct()
    pairs = near.join(first, "class").where("query <> candidate")
    vectors = classes.select(F.col("id").alias("class"), F.col("vector").alias("v"))
    scored = near.join(vectors, "class").join(queries.select(F.col("id").alias("query"), F.col("vector").alias("q")), "query").mapInArrow(_cosines, "query long, class long, score double")
    ranked = pairs.join(scored, ["query", "class"])
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "candidate"))
    ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("candidate").alias(id_col), "score")


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact cosines of pairs, each summed in the same order whatever the batch."""
    for batch in batches:
        a, b = _matrix(batch.column("v")), _matrix(batch.column("q"))
        if len(a):
            score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("class"), pa.array(score)], names=["query", "class", "score"])
