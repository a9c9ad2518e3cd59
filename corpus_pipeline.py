"""The training-text pipeline: toxic documents go, then popular lines, near-duplicates and leaked questions; what stays is packed.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. `run` applies them to `documents`; each stage's
result is written as Parquet in the shared folder and read again as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwatch.llm.common import new_folder, staged
from sensorwatch.llm.decontamination import drop_contaminated
from sensorwatch.llm.line_dedup import dedup_lines
from sensorwatch.llm.near_dedup import near_duplicates
from sensorwatch.llm.packing import pack
from sensorwatch.llm.toxicity import score_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    rejected = score_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1")
    return docs.join(rejected.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Popular lines stay in one document each; n_chars follows the text."""
    cleaned = dedup_lines(docs, new_folder(spark, "lines"))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, its smallest id."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark question go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in training sequences."""
    return pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack_documents),
]
#: Scores, signatures and tokens are not SQL: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
