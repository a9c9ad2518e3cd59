"""Token counts by source, language and tokenizer version, kept by signed deltas.

A batch of changes inserts documents, deletes them, or gives revised texts. Each becomes signed rows of a ledger: an insert adds a
document's counts, a delete takes away the counts it was inserted with, a revision does both. Totals are sums over signed rows, so
they are additive: a batch adds one small row for each (source, language, tokenizer) it touches, and totals are the sum of these rows.

Folder of a rollup, all append-only:
* `ledger/batch=<n>`: (doc_id, source, lang, tokenizer, tokens, chars, sign);
* `deltas/batch=<n>`: (source, lang, tokenizer, documents, tokens, chars) of that batch;
* `commits/batch=<n>`: the batch's name, written last. A batch that failed half way is not read, and is overwritten when it is tried
  again; a batch whose name is committed changes nothing. One writer at a time.

Tokenizers are named versions, `words@1` (ASCII blanks) and `byte_bpe_50k@1` here; a new version is a new name, and its counts stand beside the old ones.

Defined cases: a null or empty text has no tokens; null sources or languages are a group of their own. A document id is inserted once: inserting
one that is there, deleting or revising one that is not, is left out and counted in the commit's `ignored`. An id repeated in a batch counts once,
with the smallest row; a null id is ignored. In a batch deletes come first, then inserts and revisions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwatch.llm.common import staged, text_batches
from sensorwatch.llm.packing import encoder, tokenizer_file

TOKENIZERS = ("words@1", "byte_bpe_50k@1")
LEDGER = "doc_id long, source string, lang string, tokenizer string, tokens long, chars long, sign int"
DELTA = "source string, lang string, tokenizer string, documents long, tokens long, chars long"


def _count(names: tuple[str, ...], files: dict[str, str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = [(lambda t: len(t.encode("utf-8", "surrogatepass").split())) if n not in files else (lambda t, e=encoder(files[n]).encode: len(e(t)) // 4) for n in names]
        for batch in text_batches(batches):
            texts = [t or "" for t in batch.column(3).to_pylist()]
            columns = [pa.array([way(t) for t in texts], pa.int64()) for way in ways]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array([len(t) for t in texts], pa.int64()), *columns], names=["doc_id", "source", "lang", "chars", *(f"n{k}" for k in range(len(names)))])

    return count


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str, tokenizers: tuple[str, ...] = TOKENIZERS):
        """tokenizers: `words@...`, or the name of a ranks file of the public tokenizers, each with a version after an @."""
        self.spark, self.path, self.tokenizers = spark, path, tokenizers
        self.files = {n: tokenizer_file(n.split("@")[0] + ".tiktoken") for n in tokenizers if not n.startswith("words@")}

    # ---- state

    def commits(self) -> list:
        """(number, name, ignored) of each batch: one row for each."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        if not root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root):
            return []
        rows = self.spark.read.schema("number int, name string, ignored long").parquet(f"{self.path}/commits/batch=*")
        return rows.select("number", "name", "ignored").orderBy("number").collect()

    def _read(self, name: str, schema: str) -> DataFrame:
        done = [f"{self.path}/{name}/batch={r['number']}" for r in self.commits()]
        return self.spark.read.schema(schema).parquet(*done) if done else self.spark.createDataFrame([], schema)

    def live(self) -> DataFrame:
        """The counts of the documents that are in."""
        keys = ["doc_id", "source", "lang", "tokenizer", "tokens", "chars"]
        return self._read("ledger", LEDGER).groupBy(*keys).agg(F.sum("sign").alias("n")).where("n > 0").drop("n")

    def totals(self) -> DataFrame:
        rows = self._read("deltas", DELTA).groupBy("source", "lang", "tokenizer")
        return rows.agg(*(F.sum(c).alias(c) for c in ("documents", "tokens", "chars"))).where("documents <> 0 or tokens <> 0")

    # ---- changes

    def counted(self, docs: DataFrame) -> DataFrame:
        """Ledger rows of documents (doc_id, source, lang, text), a row for each tokenizer."""
        docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "source", "lang", "text")
        wide = ", ".join(f"n{k} long" for k in range(len(self.tokenizers)))
        rows = docs.mapInArrow(_count(self.tokenizers, self.files), f"doc_id long, source string, lang string, chars long, {wide}")
        each = F.create_map(*chain.from_iterable((F.lit(n), F.col(f"n{k}")) for k, n in enumerate(self.tokenizers)))
        return rows.select("doc_id", "source", "lang", "chars", F.explode(each).alias("tokenizer", "tokens")).select("doc_id", "source", "lang", "tokenizer", "tokens", "chars")

    def commit(self, name: str, inserted: DataFrame | None = None, deleted: DataFrame | None = None, revised: DataFrame | None = None) -> bool:
        """inserted, revised: (doc_id, source, lang, text); deleted: (doc_id). False when the batch had been committed."""
        done = self.commits()
        if any(r["name"] == name for r in done):
            return False
        number = max((r["number"] for r in done), default=-1) + 1
        live = self.live() if done else None
        parts, ignored = [], 0
        if inserted is not None:
            new = self._once(self.counted(inserted))
            if live is not None:
                gone = deleted.select("doc_id").distinct() if deleted is not None else None
                there = live.select("doc_id").distinct()
                there = there.join(gone, "doc_id", "left_anti") if gone is not None else there
                new = staged(new, "inserted")
                ignored += new.join(there, "doc_id", "left_semi").select("doc_id").distinct().count()
                new = new.join(there, "doc_id", "left_anti")
            parts.append(new.withColumn("sign", F.lit(1)))
        if live is not None and deleted is not None:
            ids = deleted.where("doc_id is not null").select(F.col("doc_id").cast("long")).distinct()
            parts.append(live.join(ids, "doc_id", "left_semi").withColumn("sign", F.lit(-1)))
        if live is not None and revised is not None:
            held = live
            if deleted is not None:
                held = held.join(deleted.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_anti")
            new = staged(self._once(self.counted(revised)), "revised")
            ids = new.select("doc_id").distinct()
            parts.append(held.join(ids, "doc_id", "left_semi").withColumn("sign", F.lit(-1)))
            parts.append(new.join(held.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("sign", F.lit(1)))
            ignored += ids.join(held.select("doc_id").distinct(), "doc_id", "left_anti").count()
        rows = self.spark.createDataFrame([], LEDGER)
        for part in parts:
            rows = rows.unionByName(part)
        self._write(rows, "ledger", number)
        rows = self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/batch={number}")
        # A document has one row for each tokenizer and sign, so the sum of signs counts documents.
        delta = rows.groupBy("source", "lang", "tokenizer").agg(
            F.sum("sign").cast("long").alias("documents"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"), F.sum(F.col("sign") * F.col("chars")).alias("chars")
        )
        self._write(delta, "deltas", number)
        self._write(self.spark.createDataFrame([(number, name, ignored)], "number int, name string, ignored long").coalesce(1), "commits", number)
        return True

    @staticmethod
    def _once(rows: DataFrame) -> DataFrame:
        """One row for each document and tokenizer."""
        rest = F.struct("source", "lang", "tokens", "chars")
        rows = rows.groupBy("doc_id", "tokenizer").agg(F.min(rest).alias("r"))
        return rows.select("doc_id", "r.source", "r.lang", "tokenizer", "r.tokens", "r.chars")

    def _write(self, df: DataFrame, name: str, number: int) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{name}/batch={number}")
