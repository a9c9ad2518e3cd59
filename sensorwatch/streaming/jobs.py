"""Streaming forms of the operators. Every job takes a checkpoint folder and a trigger."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.forest import ForestModel
from ..operators.refine import refine
from ..operators.thresholds import limit_alerts, with_thresholds
from ..schemas import table
from ..session import staged
from ..sources.files import drop_numbered, numbered, read_snapshot
from ..sources.messages import FRAME

LIVE = {"processingTime": "15 seconds"}
CATCH_UP = {"availableNow": True}
REPLAY_BATCHES = 10_000
BROADCAST_BYTES = 16 << 20


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp; files may carry one without a zone, which is read as UTC
    whatever the zone of the session."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return df.withColumn(column, F.from_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone()))
    return df


def to_files(df: DataFrame, path: str, checkpoint: str, trigger: dict = CATCH_UP) -> StreamingQuery:
    """Append to parquet files; the sink commits each micro-batch once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.option("path", path).trigger(**trigger).start()


def refined_stream(stream: DataFrame, codes=None, **options) -> DataFrame:
    """The batch clean-up on a stream, with category codes from a stored dictionary."""
    rows = refine(stream, **options)
    return codes.encode(rows) if codes else rows


def alert_stream(stream: DataFrame, thresholds: DataFrame, keys: Sequence[str], value: str, margin: float = 0.1, salts: int = 1) -> DataFrame:
    """Rows near or beyond their limits. The limits are a static table, read again in every micro-batch.

    Limits that are too large to be broadcast are joined by shuffle; `salts` then spreads the rows of every key over so many tasks, by a hash of
    the row, and repeats the limits as often.
    """
    if salts > 1:
        hashed = [f.name for f in stream.schema if "map<" not in f.dataType.simpleString()]
        stream = stream.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int"))
        thresholds = thresholds.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys = [*keys, "_salt"]
    alerts = limit_alerts(with_thresholds(stream, thresholds, keys, check_skew=False), value, margin)
    return alerts.drop("_salt")


def scored_stream(stream: DataFrame, model: ForestModel) -> DataFrame:
    """Score and label rows with a stored model."""
    return model.predict(stream)


def first_arrivals(stream: DataFrame, ident: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of an id that arrive within the watermark delay."""
    return event_time(stream, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(ident))


def weekly_stream(stream: DataFrame, time: str, value: str, delay: str, keys: Sequence[str] = ()) -> DataFrame:
    """Statistics per Monday week; state is one small row per open week and key."""
    timed = event_time(stream, time).withWatermark(time, delay)
    week = F.window(time, "7 days", "7 days", "4 days")
    return timed.groupBy(week.alias("w"), *keys).agg(
        F.max(value).alias("maximum"), F.min(value).alias("minimum"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"), F.count(value).alias("rows"),
    ).select(F.to_utc_timestamp("w.start", F.current_timezone()).cast("timestamp_ntz").alias("week_start"), *keys, "maximum", "minimum", "mean", "stddev", "rows")


def keep_latest(stream: DataFrame, keys: Sequence[str], path: str, checkpoint: str, trigger: dict = CATCH_UP) -> StreamingQuery:
    """Write each update of an aggregate under its micro-batch number; a repeated micro-batch
    replaces its own files. `read_latest` returns the last state of each key."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(**trigger).start()


def read_latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    updates = read_snapshot(spark, path, stored)
    rest = [f.name for f in schema.fields if f.name not in keys]
    last = F.max_by(F.struct(*rest), "batch")
    return updates.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def fold_updates(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """Fold all updates into the folder of the newest one, and remove the others. Run it while the stream is stopped."""
    numbers = numbered(spark, path, "batch")
    if len(numbers) > 1:
        staged(read_latest(spark, path, schema, keys), "folded").write.mode("overwrite").parquet(f"{path}/batch={numbers[-1]}")
        drop_numbered(spark, path, "batch", numbers[-1])


class FramedBatches:
    """Release a batch only when all of its announced rows have arrived.

    Arriving rows go to a folder per micro-batch, so a repeated micro-batch replaces its own files.
    A small table of open batches remembers the micro-batch of their first row; only folders since
    the oldest open batch that got rows now are read again. A released batch is recorded, and not
    released again within `replay` micro-batches. `release` gets the rows and the micro-batch number,
    and should write under that number, as Spark may repeat a micro-batch.

    A micro-batch starts only once the one before is committed. What that one no longer needs is
    removed then: rows older than the oldest open batch, earlier tables of open batches, and released
    batches beyond the replay horizon. So the folders hold what is open and the horizon, no more.
    """

    def __init__(self, root: str, release: Callable[[DataFrame, int], None], replay: int = REPLAY_BATCHES):
        self.arrived, self.released, self.open = f"{root}/arrived", f"{root}/released", f"{root}/open"
        self.release, self.replay = release, replay

    def _tidy(self, spark: SparkSession, batch: int) -> None:
        first = read_snapshot(spark, f"{self.open}/epoch={batch - 1}", table("batch_id string, first long")).agg(F.min("first")).first()[0]
        oldest = {self.arrived: batch - 1 if first is None else min(first, batch - 1), self.open: batch - 1, self.released: batch - self.replay}
        for folder, keep in oldest.items():
            drop_numbered(spark, folder, "epoch", keep)

    def _arrived_since(self, spark: SparkSession, first: int, last: int) -> DataFrame:
        stored = T.StructType([*FRAME.fields, T.StructField("epoch", T.LongType())])
        folders = [f"{self.arrived}/epoch={n}" for n in range(first, last + 1)]
        return spark.read.schema(stored).option("basePath", self.arrived).parquet(*folders)

    def __call__(self, frames: DataFrame, batch: int) -> None:
        spark = frames.sparkSession
        self._tidy(spark, batch)
        frames.select(*FRAME.fieldNames()).write.mode("overwrite").parquet(f"{self.arrived}/epoch={batch}")

        done = read_snapshot(spark, self.released, table("batch_id string, epoch long")).filter(F.col("epoch") < batch)
        still_open = read_snapshot(spark, f"{self.open}/epoch={batch - 1}", table("batch_id string, first long"))
        now = self._arrived_since(spark, batch, batch).select("batch_id").distinct()
        touched = now.join(done, "batch_id", "left_anti").join(still_open, "batch_id", "left")
        seen = touched.agg(F.min("first").alias("first"), F.sum(F.octet_length("batch_id") + 16).alias("bytes")).first()

        arrived = self._arrived_since(spark, batch if seen["first"] is None else seen["first"], batch)
        wanted = touched.select("batch_id")
        wanted = F.broadcast(wanted) if (seen["bytes"] or 0) <= BROADCAST_BYTES else wanted
        candidates = arrived.join(wanted, "batch_id", "left_semi")
        rows = candidates.dropDuplicates(["batch_id", "row_no"])
        sizes = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("expected_rows").alias("expected"))
        sizes.filter("n = expected").select("batch_id").write.mode("overwrite").parquet(f"{self.released}/epoch={batch}")
        ready = spark.read.schema("batch_id string").parquet(f"{self.released}/epoch={batch}")

        opened = touched.select("batch_id", F.coalesce("first", F.lit(batch).cast("long")).alias("first"))
        kept = still_open.unionByName(opened).groupBy("batch_id").agg(F.min("first").alias("first"))
        kept.join(ready, "batch_id", "left_anti").write.mode("overwrite").parquet(f"{self.open}/epoch={batch}")
        if not ready.isEmpty():
            self.release(rows.join(ready, "batch_id", "left_semi").drop("epoch"), batch)

    def start(self, frames: DataFrame, checkpoint: str, trigger: dict = CATCH_UP) -> StreamingQuery:
        writer = frames.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start()
