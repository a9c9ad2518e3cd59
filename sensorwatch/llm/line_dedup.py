"""Reversible line deduplication: sharded cuckoo filters before exact reference-count tables.

A line's key is the line without ASCII white space at its ends and with A-Z lowered. A key of at least `min_chars` code points
that at least `min_docs` documents hold is popular: it keeps its lines in the largest id holding it and loses all others.

`LineIndex` keeps this for a growing and shrinking corpus, in a shared folder, as tables that are only appended to:

* `references`: a signed row (key, id, +1 or -1) for each key of each inserted or deleted document;
* `counts`: for each key that a batch touched, its exact number of documents and its keeper after that batch; the latest row counts;
* `filters`: a cuckoo filter of the popular keys of a shard; the latest one counts. A key that becomes popular is inserted,
  one that no longer is gets deleted, so a deletion brings lines back;
* `batches`: the committed batches. It is written last: a batch that failed half way leaves nothing that is read, and one that is
  committed again changes nothing.

The filters spare the exact join most rows: only keys that pass go on to it, and it decides alone. Filters reach the tasks by
broadcast while they are under FILTER_BYTES together; beyond, the exact join takes all rows, with the same result.

Defined cases: a null or empty text is one empty line. Each row counts as a document, so a repeated row counts twice; a key held
several times by one row counts once, and the keeper keeps all its lines. Rows with a null id neither count nor lose lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwatch.llm.common import BLANKS, ascii_lower, mixed

MIN_CHARS, MIN_DOCS = 40, 5
SHARD_KEYS = 200_000
FILTER_BYTES = 64 << 20
SLOTS, KICKS = 4, 500


class CuckooFilter:
    """Buckets of four 16-bit fingerprints, a power of two of them; every key has two buckets, each found from the other."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / SLOTS / 0.8))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def read(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, "<u2").reshape(-1, SLOTS).copy())

    def bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = mixed(hashes.astype(np.uint64))
        prints = (hashes >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
        first = (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        return bucket ^ (mixed(np.asarray(prints, np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(hashes)
        return (self.table[first] == prints[:, None]).any(axis=1) | (self.table[second] == prints[:, None]).any(axis=1)

    def insert(self, hashes: np.ndarray) -> bool:
        """False when the filter is full; it must then be built anew, larger."""
        for mark, one, two in zip(*self._places(hashes)):
            if not (self._put(one, mark) or self._put(two, mark) or self._push(two, mark)):
                return False
        return True

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = mark
        return len(free) > 0

    def _push(self, bucket: int, mark: int) -> bool:
        for kick in range(KICKS):
            slot = kick % SLOTS
            mark, self.table[bucket, slot] = self.table[bucket, slot], mark
            bucket = int(self._other(np.int64(bucket), mark))
            if self._put(bucket, mark):
                return True
        return False

    def delete(self, hashes: np.ndarray) -> None:
        for mark, one, two in zip(*self._places(hashes)):
            for bucket in (one, two):
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break


def line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column, min_chars: int = MIN_CHARS) -> Column:
    """128-bit digest of the line's key; null for short ones."""
    text = ascii_lower(F.btrim(line, F.lit(BLANKS)))
    return F.when(F.length(text) >= min_chars, F.unhex(F.md5(text.cast("binary"))))


def document_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, id): the keys of each row, each once."""
    keys = F.array_distinct(F.filter(F.transform(line_array(F.col(text_col)), lambda x: line_key(x, min_chars)), F.isnotnull))
    return docs.where(F.col(id_col).isNotNull()).select(F.explode(keys).alias("key"), F.col(id_col).cast("long").alias("id"))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")


def _hash_of_keys(keys) -> np.ndarray:
    """The first eight bytes of each 16-byte key."""
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)[:, 0] if len(keys) else np.zeros(0, np.uint64)


class LineIndex:
    """See the module's text. `shards` is fixed when the index is made."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shards: int = 64):
        self.spark, self.path, self.min_docs, self.min_chars, self.shards = spark, path, min_docs, min_chars, shards

    # ---- state

    def _read(self, name: str, schema: str) -> DataFrame:
        """The rows of committed batches."""
        done = [int(r[0]) for r in self._batches()]
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{name}/v={v}" for v in done))

    def _batches(self) -> list:
        """(version, batch) of each commit: a row for each batch, not for each document."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batches")
        if not root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root):
            return []
        return self.spark.read.schema("version int, batch string").parquet(f"{self.path}/batches").orderBy("version").collect()

    def references(self) -> DataFrame:
        """(key, id, n): live references."""
        rows = self._read("references", "key binary, id long, sign int")
        return rows.groupBy("key", "id").agg(F.sum("sign").alias("n")).where("n > 0")

    def counts(self) -> DataFrame:
        """(key, n, keeper): the exact number of documents of each key, and the largest id among them."""
        rows = self._read("counts", "key binary, n long, keeper long, version int")
        if len(self._batches()) < 2:
            return rows.select("key", "n", "keeper")
        return rows.groupBy("key").agg(F.max_by(F.struct("n", "keeper"), "version").alias("c")).select("key", "c.n", "c.keeper")

    def popular(self) -> DataFrame:
        return self.counts().where(F.col("n") >= self.min_docs)

    def filters(self) -> DataFrame:
        rows = self._read("filters", "shard int, data binary, version int")
        return rows.groupBy("shard").agg(F.max_by("data", F.struct("version", F.length("data"))).alias("data"))

    # ---- changes

    def commit(self, batch: str, inserted: DataFrame | None = None, deleted: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> bool:
        """Insert and delete whole documents; a deletion names the row as it was inserted. False when the batch had been committed."""
        done = self._batches()
        if any(r["batch"] == batch for r in done):
            return False
        version = max((r["version"] for r in done), default=-1) + 1
        parts = [document_keys(d, id_col, text_col, self.min_chars).withColumn("sign", F.lit(s)) for d, s in ((inserted, 1), (deleted, -1)) if d is not None]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        self._write(rows, "references", version)
        rows = self.spark.read.schema("key binary, id long, sign int").parquet(f"{self.path}/references/v={version}")
        change = rows.groupBy("key").agg(F.sum("sign").alias("dn"), F.max(F.when(F.col("sign") > 0, F.col("id"))).alias("added"), F.max(F.when(F.col("sign") < 0, F.col("id"))).alias("gone"))
        if done:
            change = self._with_history(change, rows)
        else:
            change = change.select("key", F.col("dn").alias("n"), F.col("added").alias("keeper"), F.lit(0).cast("long").alias("before"))
        self._write(change.withColumn("version", F.lit(version)), "counts", version)
        change = self.spark.read.schema("key binary, n long, keeper long, before long").parquet(f"{self.path}/counts/v={version}")
        self._update_filters(change, version)
        self._write(self.spark.createDataFrame([(version, batch)], "version int, batch string").coalesce(1), "batches", version)
        return True

    def _write(self, df: DataFrame, name: str, version: int) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{name}/v={version}")

    def _with_history(self, change: DataFrame, rows: DataFrame) -> DataFrame:
        """New counts of the touched keys. Only keys whose keeper left look up their live references."""
        old = self.counts().withColumnsRenamed({"n": "before", "keeper": "old_keeper"})
        change = change.join(old, "key", "left").withColumns({"before": F.coalesce("before", F.lit(0)), "n": F.coalesce("before", F.lit(0)) + F.col("dn")})
        orphan = change.where("gone = old_keeper or gone >= added").select("key")
        live = self._read("references", "key binary, id long, sign int").unionByName(rows).join(orphan, "key", "left_semi")
        live = live.groupBy("key", "id").agg(F.sum("sign").alias("s")).where("s > 0").groupBy("key").agg(F.max("id").alias("live"))
        change = change.join(live.withColumn("looked", F.lit(True)), "key", "left")
        return change.select("key", "n", F.coalesce("live", F.greatest("old_keeper", "added")).alias("keeper"), "before")

    def _update_filters(self, change: DataFrame, version: int) -> None:
        """Shards in which a key became popular, or no longer is, get a new filter."""
        least = self.min_docs
        turned = change.where((F.col("n") >= least) != (F.col("before") >= least)).select(_shard(self.shards).alias("shard"), "key", (F.col("n") >= least).alias("gained"))
        old = self.filters()

        def update(key, old_filter: pd.DataFrame, turned_keys: pd.DataFrame) -> pd.DataFrame:
            if turned_keys.empty:
                return pd.DataFrame({"shard": [], "data": []})
            gained, lost = (_hash_of_keys(turned_keys.key[turned_keys.gained == g].tolist()) for g in (True, False))
            if len(old_filter) and not len(old_filter.data.iloc[0]):
                return pd.DataFrame({"shard": [key[0]], "data": [b""]})
            held = CuckooFilter.read(old_filter.data.iloc[0]) if len(old_filter) else CuckooFilter.sized(2 * len(gained))
            held.delete(lost)
            if not held.insert(gained):
                return pd.DataFrame({"shard": [key[0]], "data": [b""]})
            return pd.DataFrame({"shard": [key[0]], "data": [held.bytes()]})

        made = old.groupBy("shard").cogroup(turned.groupBy("shard")).applyInPandas(update, "shard int, data binary")
        # Filters that ran full come out empty here; the folder of filters gets the good ones and those built anew, once.
        self._write(made, "filters_made", version)
        made = self.spark.read.schema("shard int, data binary").parquet(f"{self.path}/filters_made/v={version}")
        full = [r[0] for r in made.where("length(data) = 0").select("shard").collect()]
        made = made.where("length(data) > 0")
        if full:
            made = made.unionByName(self._rebuilt(change, full))
        self._write(made.withColumn("version", F.lit(version)), "filters", version)

    def _rebuilt(self, change: DataFrame, full: list[int]) -> DataFrame:
        """(shard, data) of the filters that ran full, built anew at twice the size from the exact table."""
        least = self.min_docs
        popular = self.popular().select(_shard(self.shards).alias("shard"), "key")
        now = popular.join(change.select("key"), "key", "left_anti").unionByName(change.where(F.col("n") >= least).select(_shard(self.shards).alias("shard"), "key"))

        def build(key, keys: pd.DataFrame) -> pd.DataFrame:
            hashes, room = _hash_of_keys(keys.key.tolist()), 2 * len(keys)
            held = CuckooFilter.sized(room)
            while not held.insert(hashes):
                room *= 2
                held = CuckooFilter.sized(room)
            return pd.DataFrame({"shard": [key[0]], "data": [held.bytes()]})

        return now.where(F.col("shard").isin(full)).groupBy("shard").applyInPandas(build, "shard int, data binary")

    # ---- use

    def passing(self, keys: DataFrame) -> DataFrame:
        """The (key, id) rows whose key a filter holds: all popular ones, and one in several thousand others."""
        filters = self.filters()
        total = filters.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]
        if total > FILTER_BYTES:
            return keys
        held = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["data"]) for r in filters.collect()})

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = {s: CuckooFilter.read(d) if d else None for s, d in held.value.items()}
            for batch in batches:
                hashes = _hash_of_keys(batch.column(0).to_pylist())
                shard, found = batch.column(2).to_numpy(), np.zeros(batch.num_rows, bool)
                order = np.argsort(shard, kind="stable")
                for rows in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    if len(rows) and shard[rows[0]] in tables:
                        # An empty filter is one that cannot be read: the exact join decides about its keys.
                        table = tables[shard[rows[0]]]
                        found[rows] = True if table is None else table.contains(hashes[rows])
                yield batch.filter(pa.array(found)).select([0, 1])

        return keys.select("key", "id", _shard(self.shards).alias("shard")).mapInArrow(probe, "key binary, id long")

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: DataFrame | None = None) -> DataFrame:
        """docs with their text cleaned, and `n_lines` and `n_dropped`. keys: (key, id) rows of docs where they are at hand."""
        keys = document_keys(docs, id_col, text_col, self.min_chars) if keys is None else keys
        lost = self.passing(keys).join(self.popular().select("key", "keeper"), "key").where("id < keeper")
        lost = lost.groupBy("id").agg(F.collect_set("key").alias("_lost")).withColumnRenamed("id", "_id")
        rows = docs.join(lost, docs[id_col].cast("long") == F.col("_id"), "left").withColumn("_lines", line_array(F.col(text_col)))
        stays = lambda x: ~F.coalesce(F.array_contains("_lost", line_key(x, self.min_chars)), F.lit(False))
        rows = rows.withColumn("_kept", F.when(F.col("_lost").isNull(), F.col("_lines")).otherwise(F.filter("_lines", stays)))
        counted = {"n_lines": F.size("_lines").cast("long"), "n_dropped": (F.size("_lines") - F.size("_kept")).cast("long")}
        return rows.withColumns({**counted, text_col: F.array_join("_kept", "\n")}).drop("_id", "_lost", "_lines", "_kept")


def dedup_lines(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All of docs indexed as one batch in a new index at `path`, and cleaned by it."""
    index = LineIndex(docs.sparkSession, path)
    index.commit("all", docs, id_col=id_col, text_col=text_col)
    keys = docs.sparkSession.read.schema("key binary, id long").parquet(f"{path}/references/v=0")
    return index.clean(docs, id_col, text_col, keys)
