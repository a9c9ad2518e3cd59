"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwatch.llm.common import new_folder, staged
from sensorwatch.llm.cross_polytope import nearest
from sensorwatch.llm.decontamination import contaminated
from sensorwatch.llm.languages import document_languages, fit_languages
from sensorwatch.llm.lexical_search import SEARCH_SQL, top_documents
from sensorwatch.llm.line_dedup import dedup_lines
from sensorwatch.llm.near_dedup import near_duplicates
from sensorwatch.llm.packing import pack
from sensorwatch.llm.passages import repeated_passages
from sensorwatch.llm.phrases import PHRASES_SQL, collocations
from sensorwatch.llm.pseudonyms import pseudonymised
from sensorwatch.llm.quotes import linked_conversations
from sensorwatch.llm.rollup import TokenRollup
from sensorwatch.llm.toxicity import score_documents

#: Of the registered query only; a production key comes from the caller.
SAMPLE_KEY = "sample key of the catalogue"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return linked_conversations(table(spark, folder, "conversations"))


def op2_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents come in; those labelled toxic are withdrawn; those of low quality are counted anew with single blanks; every batch is sent twice."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rollup = TokenRollup(spark, new_folder(spark, "rollup"))
    low = staged(labels.where("quality = 0").select("doc_id"), "low")
    revised = docs.join(low, "doc_id", "left_semi").withColumn("text", F.regexp_replace(F.trim("text"), r"\s+", " "))
    for _ in range(2):
        rollup.commit("arrivals", inserted=docs)
        rollup.commit("corrections", deleted=labels.where("toxic = 1").select("doc_id"), revised=revised)
    return rollup.totals()


def op3_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonymised(table(spark, folder, "documents"), SAMPLE_KEY).select("doc_id", "n_replaced", "replaced", "text")


def op4_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_noisy_channel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


def op7_collinear_chaining(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


def op8_minhash_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def op10_cuckoo_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, folder, "documents"), new_folder(spark, "lines"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_document_fp_tree(spark: SparkSession, folder: str) -> DataFrame:
    return top_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 10)


def op12_fm_index_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op13_crf_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose crc32(doc_id as text) mod 3 is not 1 are learned from; a null id is held out, too."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))
    predicted = document_languages(docs, fit_languages(docs.where(~held_out)))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


OPERATORS = (
    op1_quotation_linking, op2_token_rollup, op3_feistel_pseudonyms, op4_template_decontamination, op5_noisy_channel_toxicity,
    op6_cross_polytope, op7_collinear_chaining, op8_minhash_bayes, op9_best_fit_packing, op10_cuckoo_line_dedup,
    op11_document_fp_tree, op12_fm_index_collocations, op13_crf_languages,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in OPERATORS}
SQL: dict[str, str] = {
    "op11_document_fp_tree": SEARCH_SQL,
    "op12_fm_index_collocations": PHRASES_SQL,
    "op10_cuckoo_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
            FROM documents),
        keyed AS (
            SELECT doc_id, place, line,
                   translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        popular AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        marked AS (
            SELECT k.doc_id, k.place, k.line, coalesce(k.doc_id < p.keeper, false) AS lost FROM keyed k LEFT JOIN popular p USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
}
