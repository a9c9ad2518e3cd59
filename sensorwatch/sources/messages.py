"""Rows as JSON messages. Each message names its batch and the number of rows of the batch, so a
reader can tell a complete batch from a partial one whatever the arrival order."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.skew import NO_GROUPS, attach, hot_groups
from ..schemas import table

FRAME = table("batch_id string, expected_rows long, row_no string, payload string")


def encode_rows(df: DataFrame, keep_nulls: bool = True) -> Column:
    """Row as JSON text, with nulls written out unless told otherwise."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(not keep_nulls).lower()})


def to_messages(df: DataFrame, batch_id: str | Column, row_id: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One message per row. `row_id` must tell rows apart; it makes replays recognisable. With `by`
    there is one batch per value of those columns, and `batch_id` is a column made of them."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_expected"))
    counted = attach(df, sizes, by, hot_groups(df, by) if by else NO_GROUPS)
    framed = counted.select(
        (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).alias("batch_id"),
        F.col("_expected").alias("expected_rows"),
        F.concat_ws("/", *[F.col(c).cast("string") for c in row_id]).alias("row_no"), encode_rows(df).alias("payload"),
    )
    return framed.select(F.to_json(F.struct(*framed.columns)).alias("value"))


def publish(messages: DataFrame, options: dict[str, str], fmt: str = "kafka", path: str | None = None) -> None:
    """Send to a topic, or append text files for a file-based reader."""
    writer = messages.write.format(fmt).options(**options)
    writer.save() if fmt == "kafka" else writer.mode("append").save(path)


def read_stream(spark: SparkSession, options: dict[str, str], fmt: str = "kafka", path: str | None = None) -> DataFrame:
    """`value` text of a topic from its earliest offset, or of a folder of text files.

    Offsets are kept in the checkpoint of the query, together with its results.
    """
    if fmt == "kafka":
        stream = spark.readStream.format("kafka").option("startingOffsets", "earliest").options(**options).load()
        return stream.select(F.col("value").cast("string").alias("value"))
    return spark.readStream.format("text").options(**options).load(path)


def decode_frames(messages: DataFrame) -> DataFrame:
    """Frames of the messages that name a batch; `unreadable_messages` has the others."""
    return messages.select(F.from_json("value", FRAME).alias("m")).filter("m.batch_id is not null").select("m.*")


def unreadable_messages(messages: DataFrame) -> DataFrame:
    """`value` of the messages that name no batch or hold no row: they can never complete a batch, so they are kept apart."""
    frame = F.from_json("value", FRAME)
    readable = frame["batch_id"].isNotNull() & F.coalesce(F.try_parse_json(frame["payload"]).isNotNull(), F.lit(False))
    return messages.select("value").filter(~F.coalesce(readable, F.lit(False)))


def decode_rows(frames: DataFrame, schema: T.StructType, column: str = "payload") -> DataFrame:
    return frames.select(*[c for c in frames.columns if c != column], F.from_json(column, schema).alias("_row")).select(
        *[c for c in frames.columns if c != column], "_row.*"
    )
