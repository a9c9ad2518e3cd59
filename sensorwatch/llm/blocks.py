"""Comparing two sides of a group in blocks of bounded size, whatever the group's size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["key", "i", "j"]


def in_blocks(left: DataFrame, right: DataFrame, size: int, payload: DataFrame | None = None) -> DataFrame:
    """Rows (key long, i, j, side, id long, ...) in which every row of `left` meets every row of `right` of its key in just one (key, i, j).

    Each side of a key is cut by a hash of its id into chunks of about `size` rows, and a chunk is dealt to every chunk of the other
    side: a task holds two chunks at a time. payload (id, ...) is joined to the rows by id, and by side where it has that column. Rows come grouped by (key, i, j), side 0 first.
    """
    sides = left.select(F.lit(0).alias("side"), "key", "id", *_rest(left)).unionByName(right.select(F.lit(1).alias("side"), "key", "id", *_rest(right)))
    cuts = sides.groupBy("key").agg(*(F.ceil(F.count(F.when(F.col("side") == k, 1)) / size).cast("int").alias(f"n{k}") for k in (0, 1))).where("n0 > 0 and n1 > 0").hint("rebalance")  # so that the join shuffles by key itself, and can split a skewed one
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    dealt = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    rows = sides.join(cuts, "key").withColumns(
        {"own": F.when(F.col("side") == 0, own("n0")).otherwise(own("n1")), "other": F.explode(F.when(F.col("side") == 0, dealt("n1")).otherwise(dealt("n0")))}
    )
    rows = rows.withColumns({"i": F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")), "j": F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own"))})
    rows = rows.drop("n0", "n1", "own", "other")
    if payload is not None:
        rows = rows.join(payload, ["id", "side"] if "side" in payload.columns else "id")
    rest = [c for c in rows.columns if c not in (*KEYS, "side", "id")]
    return rows.select(*KEYS, "side", "id", *rest).repartition(*KEYS).sortWithinPartitions(*KEYS, "side")


def _rest(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("key", "id")]


def groups(batches: Iterator[pa.RecordBatch], keys: int = 3) -> Iterator[pa.Table]:
    """Whole groups of rows that follow each other and agree in their first `keys` columns, one table each; a group may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        bounds = [0, *change.tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:]):
            here = tuple(c[start] for c in columns)
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = here
    if held:
        yield pa.Table.from_batches(held)
