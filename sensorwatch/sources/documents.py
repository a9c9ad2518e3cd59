"""Large column documents {column: {index: value}}, read in pieces.

`read_column_documents` takes a file as one value. Here a file is read as comma-separated fragments, which Spark splits by byte ranges, so
a task holds one fragment at a time and a document of any size is spread over the cluster:

1. the fragments of each block (byte range) are scanned for quotes: an odd number before a block means that it begins inside a string;
2. each block is read in order: fragments that belong to one string are put together, and a cell is parsed when it is whole. What is left open at the end of a
   block and what closes it at the beginning of the next one are joined (one row a block at most);
3. a cell before the first column name of its block belongs to the last name of the blocks before it, a table of one row a block.

The cells are then turned into rows as before. Values are numbers, texts, booleans and null. A document that is not of this form raises an error; so does a
text that spans more than two blocks.
"""

import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..session import staged

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = re.compile(r'\s*\{?\s*("(?:[^"\\]|\\.)*")\s*:\s*\{', re.S)
INDEX = re.compile(r'\s*("(?:[^"\\]|\\.)*")\s*:\s*', re.S)
TEXT = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
PLAIN = re.compile(r"[^\s{},\"\[\]]+")
PARSED = "source_file string, block long, kind string, column string, source_index string, cell string"


def _quotes(text: str) -> int:
    """Quotes that open or close a string."""
    return text.replace("\\\\", "").replace('\\"', "").count('"')


def _parsed(text: str) -> list[tuple[str | None, str | None, str | None]]:
    """(column, index, value) of one whole fragment: a name if it opens a column, a cell if it holds one."""
    column, at = None, 0
    if name := NAME.match(text):
        column, at = json.loads(name[1]), name.end()
    if index := INDEX.match(text, at):
        place = index.end()
        if value := TEXT.match(text, place):
            cell = json.loads(value[0])
        elif value := PLAIN.match(text, place):
            cell = None if value[0] == "null" else value[0]
        else:
            raise ValueError(f"not a cell: {text[:80]!r}")
        if text[value.end() :].strip().strip("}").strip().strip("}"):
            raise ValueError(f"not a cell: {text[:80]!r}")
        return [(column, json.loads(index[1]), cell)]
    if text[at:].strip(" \t\r\n{}"):
        raise ValueError(f"not a cell: {text[:80]!r}")
    return [(column, None, None)] if column is not None else []


def _count_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, int], int] = {}
    for batch in batches:
        for file, block, text in zip(*(c.to_pylist() for c in batch.columns)):
            counts[file, block] = counts.get((file, block), 0) + _quotes(text)
    files, blocks = zip(*counts) if counts else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(blocks, pa.int64()), pa.array(counts.values(), pa.int64())], ["source_file", "block", "quotes"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells with their column where the block has named it, the last name (kind `name`), and what is open at both ends of the block (`head`, `tail`)."""
    now, column, held, inside = None, None, None, False

    def ends():
        if now is not None:
            if held is not None:
                out.append((*now, "head" if inside else "tail", None, None, held))
            if column is not None:
                out.append((*now, "name", column, None, None))

    for batch in batches:
        out: list[tuple] = []
        for file, block, text, begins_inside in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != now:
                ends()
                now, column, held, inside = (file, block), None, None, begins_inside
            held = text if held is None else f"{held},{text}"
            if (_quotes(held) + inside) % 2:
                continue
            if inside:
                out.append((*now, "head", None, None, held))
                inside = False
            else:
                for name, index, cell in _parsed(held):
                    column = name if name is not None else column
                    if index is not None:
                        out.append((*now, "cell", column, index, cell))
            held = None
        yield _batch(out)
    out = []
    ends()
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 6
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["source_file", "block", "kind", "column", "source_index", "cell"])


def _seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole fragments made of a tail and the head of the next block."""
    for batch in batches:
        out = []
        for file, block, text in zip(*(c.to_pylist() for c in batch.columns)):
            for name, index, cell in _parsed(text):
                out.append((file, block, "cell", name, index, cell))
        yield _batch(out)


def read_column_documents_in_pieces(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """`read_column_documents` for documents of any size: the same rows."""
    text = spark.read.option("lineSep", ",").text(path)
    fragments = text.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), "value")
    blocks = staged(fragments.mapInArrow(_count_quotes, "source_file string, block long, quotes long"), "blocks")
    in_order = Window.partitionBy("source_file").orderBy("block")
    before = F.coalesce(F.sum("quotes").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("source_file", "block", (before % 2 == 1).alias("inside"), F.lead("block").over(in_order).alias("next"))
    # One row for each byte range of maxPartitionBytes: the fragments stay in their order beside a broadcast table.
    marked = fragments.join(F.broadcast(starts.drop("next")), ["source_file", "block"]).select("source_file", "block", "value", "inside")
    parsed = staged(marked.mapInArrow(_cells, PARSED), "cells")
    part = lambda kind: parsed.filter(F.col("kind") == kind)
    heads = part("head").select("source_file", F.col("block").alias("next"), F.col("cell").alias("head"))
    open_ends = part("tail").join(starts.select("source_file", "block", "next"), ["source_file", "block"]).join(heads, ["source_file", "next"], "left")
    whole = F.coalesce(F.concat_ws(",", "cell", "head"), F.col("cell"))
    seams = staged(open_ends.select("source_file", "block", whole.alias("text")).mapInArrow(_seams, PARSED), "seams")
    # A name in a seam comes after all others of its block.
    last = starts.select("source_file", "block").join(
        part("name").select("source_file", "block", F.col("column").alias("inner")), ["source_file", "block"], "left"
    ).join(seams.filter("column is not null").select("source_file", "block", F.col("column").alias("seam")), ["source_file", "block"], "left")
    carried = last.select(
        "source_file", "block", "inner",
        F.last(F.coalesce("seam", "inner"), True).over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
    )
    cells = part("cell").withColumn("at_seam", F.lit(False)).unionByName(seams.withColumn("at_seam", F.lit(True)))
    placed = cells.join(F.broadcast(carried), ["source_file", "block"], "left")
    column = F.coalesce("column", F.when(F.col("at_seam"), F.col("inner")), "earlier")
    cells = placed.filter("source_index is not null").select("source_file", column.alias("column"), "source_index", "cell")
    wide = cells.groupBy("source_file", "source_index").pivot("column", schema.fieldNames()).agg(F.first("cell"))
    return wide.select(
        "source_file", F.col("source_index").cast("long").alias("source_index"),
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields],
    )
