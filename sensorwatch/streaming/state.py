"""Streaming operators that keep keyed state in the state store.

The state lives in the query's checkpoint (RocksDB, with changelogs in the shared folder), so nothing but the checkpoint remembers anything, a
restart goes on where the last committed micro-batch ended, and what has expired is removed by the store itself.
"""

import sys
from base64 import b64decode, b64encode
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.messages import FRAME
from .jobs import event_time

# Executors need not have this package: its classes travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RELEASED = T.StructType([*FRAME.fields, T.StructField("complete", T.BooleanType())])
CHUNK_ROWS = 10_000
#: Rows of a batch as they are held.
HELD = pa.schema([("row_no", pa.large_string()), ("payload", pa.large_string())])


def use_state_store(spark: SparkSession) -> None:
    """The store that keyed state needs; set it before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class BatchRelease(StatefulProcessor):
    """Holds the rows of a batch until all that are announced have come.

    Rows are appended as they arrive, in compressed blocks, repeats included, and counted. Only when as many have come as are announced are they read: if they
    are all different the batch is released, else the repeats are removed and the count put right. A released batch stays marked, so that replays
    find it, until no row of it has come for the horizon; an incomplete one is then given up, its rows returned as not complete.
    """

    def __init__(self, time: str):
        self.time = time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "row_no string, payload string")
        self.facts = handle.getValueState("facts", "held long, expected long, released boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due = list(self.handle.listTimers())
        if due and max(due) < timerValues.getCurrentWatermarkInMs():  # rows are handed over before timers are
            yield from self._given_up(key)
        for timer in due:
            self.handle.deleteTimer(timer)
        held, expected, released = self.facts.get() if self.facts.exists() else (0, 0, False)
        newest = max(due, default=0)
        for frame in rows:
            frame.columns = [*FRAME.fieldNames(), self.time]
            newest = max(newest, int(frame[self.time].max().timestamp() * 1000))
            if released:
                continue
            expected = max(expected, int(frame["expected_rows"].max()))
            columns = [pa.array(frame[c], type=HELD.field(c).type, from_pandas=True) for c in HELD.names]
            self.rows.appendList(self._blocks(pa.Table.from_arrays(columns, schema=HELD)))
            held += len(frame)
        if not released and held >= expected:
            distinct = self._distinct()
            if len(distinct) >= expected:
                yield from self._frames(key[0], distinct, expected, True)
                self.rows.clear()
                held, released = 0, True
            elif len(distinct) < held:
                self.rows.put(self._blocks(distinct))
                held = len(distinct)
        self.facts.update((held, expected, released))
        self.handle.registerTimer(newest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._given_up(key)

    def _given_up(self, key) -> Iterator[pd.DataFrame]:
        held, expected, released = self.facts.get() if self.facts.exists() else (0, 0, True)
        if not released:
            yield from self._frames(key[0], self._distinct(), expected, False)
        self.rows.clear()
        self.facts.clear()

    @staticmethod
    def _blocks(rows: pa.Table) -> list[tuple[str, str]]:
        """The rows as values of the list state: the bytes of a block, and the block compressed. All of it is text, as a list state returns other types as text."""
        plain = [batch.serialize() for batch in rows.to_batches(CHUNK_ROWS)]
        return [(str(block.size), b64encode(pa.compress(block, codec="zstd", asbytes=True)).decode()) for block in plain]

    def _distinct(self) -> pa.Table:
        """The held rows; of repeats, the first one."""
        batches = [pa.ipc.read_record_batch(pa.decompress(b64decode(block), int(size), codec="zstd"), HELD) for size, block in self.rows.get()]
        rows = pa.Table.from_batches(batches, HELD)
        first = rows.append_column("at", pa.array(np.arange(len(rows)))).group_by("row_no").aggregate([("at", "min")])["at_min"]
        return rows if len(first) == len(rows) else rows.take(first)

    @staticmethod
    def _frames(batch: str, rows: pa.Table, expected: int, complete: bool) -> Iterator[pd.DataFrame]:
        for at in range(0, len(rows), CHUNK_ROWS):
            part = rows.slice(at, CHUNK_ROWS).to_pandas()
            yield part.assign(batch_id=batch, expected_rows=expected, complete=complete)[[f.name for f in RELEASED.fields]]

    def close(self) -> None:
        pass


def release_batches(frames: DataFrame, time: str, horizon: str) -> DataFrame:
    """The rows of each batch once all of its announced rows have arrived, as `complete`; those of a batch that is still incomplete when the stream has
    moved on by the horizon since its last row, as not complete. Each row number is returned once.

    `frames` has the columns of a frame and an event time. A batch is one key of the state: its rows come out of one task, in chunks, so a batch
    should be a day or a station, not the whole stream. A frame that arrives later than the horizon is dropped by the watermark; a row of a batch
    that has been released or given up longer ago than the horizon starts it anew.
    """
    timed = event_time(frames, time).withWatermark(time, horizon).select(*FRAME.fieldNames(), time)
    return timed.groupBy("batch_id").transformWithStateInPandas(
        statefulProcessor=BatchRelease(time), outputStructType=RELEASED, outputMode="Append", timeMode="EventTime"
    )


class RollingBands(StatefulProcessor):
    """Remembers the place of the last row of a key and the values of the last `rows - 1` ones."""

    def __init__(self, keys: Sequence[str], order: str, features: Sequence[str], rows: int, sigma: float, idle_ms: int | None):
        self.keys, self.order, self.features, self.size, self.sigma, self.idle = list(keys), order, list(features), rows, sigma, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        arrays = ", ".join(f"v{i} array<double>" for i in range(len(self.features)))
        self.tail = handle.getValueState("tail", f"place long, {arrays}", self.idle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        here = pd.concat(list(rows), ignore_index=True)
        here.columns = [*self.keys, self.order, *self.features, "_place"]  # names that begin with an underscore do not arrive
        here = here.sort_values("_place", kind="stable").drop_duplicates("_place")
        last, *tails = self.tail.get() if self.tail.exists() else (None, *[[] for _ in self.features])
        if last is not None:
            here = here[here["_place"] > last]
        if here.empty:
            return
        out = {k: here[k].to_numpy() for k in [*self.keys, self.order]}
        kept = []
        for feature, tail in zip(self.features, tails):
            before = np.array([np.nan if v is None else v for v in tail], dtype=float)
            values = np.concatenate((before, here[feature].to_numpy(dtype=float, na_value=np.nan)))
            padded = np.concatenate((np.full(self.size - 1, np.nan), values))
            windows = np.lib.stride_tricks.sliding_window_view(padded, self.size)[len(before) :]
            count = np.sum(~np.isnan(windows), axis=1)
            with np.errstate(invalid="ignore", divide="ignore"):
                mean = np.where(count > 0, np.nansum(windows, axis=1) / count, np.nan)
                squares = np.nansum((windows - mean[:, None]) ** 2, axis=1)
                std = np.where(count > 1, np.sqrt(squares / (count - 1)), np.nan)
            out |= {
                feature: values[len(before) :], f"{feature}_ma": mean, f"{feature}_std": std,
                f"{feature}_spc_lower": mean - self.sigma * std, f"{feature}_spc_upper": mean + self.sigma * std,
            }
            kept.append([None if np.isnan(v) else float(v) for v in values[len(values) - min(len(values), self.size - 1) :]])
        self.tail.update((int(here["_place"].iloc[-1]), *kept))
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def rolling_bands_stream(stream: DataFrame, features: Sequence[str], keys: Sequence[str], order: str, rows: int = 10, sigma: float = 2.0,
                         idle_ms: int | None = None) -> DataFrame:
    """Keys, order, and for each feature its value, rolling mean, sample deviation and band over the current and the previous `rows - 1` rows of its key, for
    every arriving row: the lines of `control_bands` over the same rows, if they arrive in order from one micro-batch to the next.

    `order` is a whole number or a timestamp, unique within a key. Rows of a micro-batch are sorted by it. A row at or before the last one of its key is late, or a
    repeat, and is dropped: the lines of later rows have been given out. Missing values are skipped. With `idle_ms`, a key forgets
    its rows when none has come for so long by the clock; such a stream runs micro-batches until it is stopped, so give it a live trigger. State is `rows` numbers for each key and feature; a key's rows of one micro-batch are sorted
    in one task, so bound the micro-batches.
    """
    kind = stream.schema[order].dataType
    place = F.unix_micros(F.col(order)) if isinstance(kind, T.TimestampType) else F.col(order).cast("long")
    lines = ["_ma", "_std", "_spc_lower", "_spc_upper"]
    schema = T.StructType(
        [stream.schema[k] for k in [*keys, order]] + [T.StructField(f"{f}{x}", T.DoubleType()) for f in features for x in ["", *lines]]
    )
    chosen = stream.select(*keys, order, *[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features], place.alias("_place"))
    found = chosen.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=RollingBands(keys, order, features, rows, sigma, idle_ms), outputStructType=schema, outputMode="Append",
        timeMode="ProcessingTime" if idle_ms else "None",
    )
    numbers = [f"{f}{x}" for f in features for x in ["", *lines]]
    return found.withColumns({n: F.nanvl(F.col(n), F.lit(None).cast("double")) for n in numbers})
