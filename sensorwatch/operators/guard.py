"""Writes that must not repeat a period."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import staged

def new_period_rows(new: DataFrame, existing: DataFrame, keys: Sequence[str], on_conflict: str = "skip_batch") -> DataFrame:
    """Rows of `new` that may be appended.

    skip_rows leaves out the periods that exist. skip_batch leaves out everything as soon as one
    period exists. Stored periods are reduced to their distinct keys before the join; under skip_batch
    `new` is read twice, so pass a staged frame (as append_new_periods does).
    """
    stored = existing.select(*keys).distinct()
    if on_conflict == "skip_rows":
        return new.join(stored, list(keys), "left_anti")
    if on_conflict == "skip_batch":
        overlap = new.select(*keys).distinct().join(stored, list(keys), "left_semi")
        return new.filter(overlap.agg(F.count(F.lit(1)) == 0).scalar())
    raise ValueError(f"unknown on_conflict: {on_conflict}")


def append_new_periods(new: DataFrame, path: str, keys: Sequence[str], on_conflict: str = "skip_batch",
                       partition_by: Sequence[str] = ()) -> None:
    """Append to a parquet table under the guard; the first write creates the table.

    Rows are rebalanced by their partition columns first: a partition gets few files, and a large one
    is still written by several tasks.
    """
    from ..sources.files import read_snapshot

    if on_conflict == "skip_batch":
        new = staged(new, "guarded")
    existing = read_snapshot(new.sparkSession, path, new.schema)
    allowed = new_period_rows(new, existing, keys, on_conflict)
    if partition_by:
        allowed = allowed.hint("rebalance", *partition_by)
    allowed.write.mode("append").partitionBy(*partition_by).parquet(path)
