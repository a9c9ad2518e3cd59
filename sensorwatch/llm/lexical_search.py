"""Ranked lexical search: the documents that score highest for each item, found in a document FP-tree by branch and bound.

Method: one scan counts, for every document, its terms and how often it holds each term of the items (its restricted vector). Each task then reads
its vectors shard by shard. In a shard every vector is written in the order of falling document frequency, and documents whose vectors begin
alike share a path of a trie; a node keeps the largest count of each term and the smallest length norm of the documents below it. Since a score
grows with the counts and falls with the norm, they bound the score of all these documents. Each item walks the trie depth first, the most
promising child first, and skips what cannot reach its k-th best so far. A task keeps k documents for each item over all its shards; the last
step ranks those of all tasks. Nothing is shuffled but these few rows.

Terms are the maximal runs of ASCII digits, ASCII letters and characters beyond ASCII, with A-Z lowered. Scores are whole numbers, so they are the
same on any machine; equal scores go to the smaller doc_id.

Memory: a shard holds at most SHARD_DOCS documents or the few that pass SHARD_TERMS counts; maxima are kept for BLOCK_TERMS terms at a time; the
terms that one scan looks for are at most PASS_TERMS (more items mean more scans). An item of more terms than a block is a block by itself.

Odd input: a null or empty text, and one without terms, has no part in any count and is never returned. Null and empty items return no row. Items
that share an item_id (null among them) are one item that holds the terms of all. Repeated documents are documents of their own; with equal ids
too, they take ranks side by side; a null doc_id comes after all others of its score. Texts of any length are read whole, in pieces. Without
documents or items the result is empty. Other columns of either table, whatever their names, have no influence.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorwatch.llm.common import staged, union_all

# Executors need not have this package: the functions of this module travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD_DOCS, SHARD_TERMS = 16_384, 1 << 22
LEAF_DOCS = 64
BLOCK_TERMS, PASS_TERMS = 8_192, 1 << 18
#: A longer text is split into terms piece by piece.
PIECE_BYTES = 1 << 20
#: A-Z lowered; ASCII characters that no term holds become blanks; bytes of characters beyond ASCII stay.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
VECTORS = "doc_id long, n_terms long, terms array<int>, counts array<int>"
FOUND = "item_id long, doc_id long, score long"


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists that are each made from a bounded piece (a term is never cut)."""
    start = 0
    while start < len(text):
        end = min(start + PIECE_BYTES, len(text))
        piece = text[start:end].translate(TERM_BYTES)
        if end < len(text):
            cut = piece.rfind(b" ")
            while cut < 0 and end < len(text):  # one term fills the piece
                end = min(end + PIECE_BYTES, len(text))
                piece = text[start:end].translate(TERM_BYTES)
                cut = piece.rfind(b" ")
            if end < len(text):
                piece, end = piece[:cut], start + cut
        yield piece.split()
        start = end + (end == start)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0. docs: doc_id, text; items: item_id, text."""
    spark = docs.sparkSession
    texts, stats, found = docs.select(F.col("doc_id").cast("long"), "text"), None, []
    for queries in _passes(items):
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, terms in queries for t in terms))}
        vectors = staged(texts.mapInArrow(_counting(spark.sparkContext.broadcast(vocabulary)), VECTORS), "vectors")
        stats = stats or vectors.agg(F.count("*"), F.sum("n_terms")).first()
        if not stats[0]:
            break
        frequency = np.zeros(len(vocabulary), np.int64)
        for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            frequency[term] = n
        plan = _plan(queries, vocabulary, frequency, stats[0])
        search = _searching(spark.sparkContext.broadcast(plan), stats[0], stats[1], k)
        found.append(staged(vectors.mapInArrow(search, FOUND), "found"))
    if not found:
        found = [spark.createDataFrame([], FOUND)]
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = union_all(found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _passes(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """(item_id, distinct terms) of the items, as many at a time as hold PASS_TERMS terms. Items come to the driver one partition after the other."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = batch.column(0), [
                list({t for piece in term_pieces(x or b"") for t in piece}) for x in batch.column(1).cast(pa.binary()).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    each = items.select(F.col("item_id").cast("long"), "text").mapInArrow(split, "item_id long, terms array<binary>")
    merged = each.select("item_id", F.explode("terms").alias("t")).groupBy("item_id").agg(F.array_sort(F.collect_set("t")).alias("terms"))
    taken, seen = [], set()
    for row in merged.toLocalIterator():
        terms = [bytes(t) for t in row.terms]
        if taken and len(seen.union(terms)) > PASS_TERMS:
            yield taken
            taken, seen = [], set()
        taken.append((row.item_id, terms))
        seen.update(terms)
    if taken:
        yield taken


def _counting(vocabulary):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocabulary.value.get
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ids, lengths, ends, terms, counts = [], [], [0], [], []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                    held, n = Counter(), 0
                    for piece in term_pieces(text.as_py() or b""):
                        held.update(map(find, piece))
                        n += len(piece)
                    if not n:
                        continue
                    held.pop(None, None)
                    ids.append(doc_id)
                    lengths.append(n)
                    terms.extend(held.keys())
                    counts.extend(held.values())
                    ends.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n_terms", "terms", "counts"])

    return count


def _plan(queries: list, vocabulary: dict[bytes, int], frequency: np.ndarray, n_docs: int) -> list[tuple]:
    """Blocks of items: (place of each term of the vocabulary in the block by falling frequency or -1, number of terms, [(item_id, places, weights)])."""
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)
    order = np.lexsort((np.arange(len(frequency)), -frequency))
    blocks, taken, seen = [], [], set()

    def close() -> None:
        place = np.full(len(frequency), -1, np.int32)
        used = order[np.isin(order, np.fromiter(seen, np.int64, len(seen)))]
        place[used] = np.arange(len(used))
        blocks.append((place, len(used), [(item, place[ids], weight[ids]) for item, ids in taken]))

    for item, terms in queries:
        ids = np.array([vocabulary[t] for t in terms], np.int64)
        ids = ids[(frequency[ids] > 0) & (weight[ids] > 0)]
        if not len(ids):
            continue
        if taken and len(seen.union(ids.tolist())) > BLOCK_TERMS:
            close()
            taken, seen = [], set()
        taken.append((item, ids))
        seen.update(ids.tolist())
    if taken:
        close()
    return blocks


def _searching(plan, n_docs: int, n_terms: int, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = plan.value
        best = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items) for _, _, items in blocks]
        for shard in _shards(batches):
            ids, lengths, sizes, terms, counts = shard
            # Whole numbers of any size: 90 * n * N may pass 64 bits in a very long text.
            norm = np.array([10 + 90 * int(n) * n_docs // n_terms for n in lengths], np.int64)
            for (place, width, items), kept in zip(blocks, best):
                tree = DocumentTree(ids, norm, sizes, place[terms], counts, width)
                for i, (_, places, weights) in enumerate(items):
                    kept[i] = tree.best(places, weights, k, kept[i])
        rows = [(item, s, d) for (_, _, items), kept in zip(blocks, best) for (item, _, _), (score, doc) in zip(items, kept) for s, d in zip(score.tolist(), doc.tolist())]
        if rows:
            item, score, doc = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array([None if d == NO_ID else d for d in doc], pa.int64()), pa.array(score, pa.int64())],
                ["item_id", "doc_id", "score"],
            )

    return search


#: Stands for a null doc_id inside a task: after all others.
NO_ID = np.iinfo(np.int64).max


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc_id, n_terms, number of counts, terms, counts) of bounded numbers of documents."""
    parts, docs, held = [], 0, 0

    def whole() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in zip(*parts))

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, 1024)
            at += part.num_rows
            terms, counts = part.column(2), part.column(3)
            parts.append((
                part.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False),
                np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(), counts.flatten().to_numpy(),
            ))
            docs, held = docs + part.num_rows, held + len(parts[-1][3])
            if docs >= SHARD_DOCS or held >= SHARD_TERMS:
                yield whole()
                parts, docs, held = [], 0, 0
    if parts:
        yield whole()


class DocumentTree:
    """A trie of documents by their terms in order of falling frequency, with bounds for what lies below each node.

    A node with at most LEAF_DOCS documents is a leaf, and neighbouring small children share one; documents that end at a node are leaves by norm.
    """

    def __init__(self, ids: np.ndarray, norm: np.ndarray, sizes: np.ndarray, places: np.ndarray, counts: np.ndarray, width: int):
        owner = np.repeat(np.arange(len(sizes)), sizes)
        keep = places >= 0
        owner, places, counts = owner[keep], places[keep], counts[keep]
        order = np.lexsort((places, owner))
        owner, places, counts = owner[order], places[order], counts[order]
        sizes = np.bincount(owner, minlength=len(sizes))
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.children: list[list[int]] = []
        leaf_docs = self._grow(starts, sizes, places, norm)
        docs = np.concatenate([x for x in leaf_docs if x is not None] or [np.zeros(0, np.int64)])
        # Counts follow the leaves, so that a leaf is one run of them.
        spans = sizes[docs]
        ends = np.cumsum(spans)
        pick = np.repeat(starts[docs] - (ends - spans), spans) + np.arange(spans.sum())
        self.ids, self.term, count = ids[docs], places[pick], counts[pick].astype(np.int64)
        self.starts = ends - spans
        self.impact = 1_000_000_000 * count // (1000 * count + 8 * np.repeat(norm[docs], spans))
        self.leaves: list[tuple[int, int] | None] = []
        largest, smallest = np.zeros((len(leaf_docs), width), np.int32), np.full(len(leaf_docs), NO_ID // 16)
        at = 0
        for node, held in enumerate(leaf_docs):
            if held is None:
                self.leaves.append(None)
                continue
            self.leaves.append((at, at + len(held)))
            a, b = self._run(at, at + len(held))
            np.maximum.at(largest[node], self.term[a:b], count[a:b].astype(np.int32))
            smallest[node] = norm[held].min(initial=smallest[node])
            at += len(held)
        for node in range(len(leaf_docs) - 1, -1, -1):  # children have larger numbers than their parent
            if below := self.children[node]:
                largest[node], smallest[node] = largest[below].max(axis=0), smallest[below].min()
        top = largest.astype(np.int64)
        self.bound = (1_000_000_000 * top // (1000 * top + 8 * smallest[:, None])).astype(np.int32)
        self.width = width

    def _grow(self, starts: np.ndarray, sizes: np.ndarray, places: np.ndarray, norm: np.ndarray) -> list[np.ndarray | None]:
        """Numbers the nodes, parents first; the documents of each leaf, None for an inner node."""
        held: list[np.ndarray | None] = [None]
        self.children.append([])
        pending = [(0, np.flatnonzero(sizes > 0), 0)]
        while pending:
            node, docs, depth = pending.pop()
            if len(docs) <= LEAF_DOCS:
                held[node] = docs
                continue
            while True:  # a path without a branch is one node
                ended = sizes[docs] == depth
                step = np.where(ended, -1, places[np.minimum(starts[docs] + depth, len(places) - 1)])
                if ended.any() or step.min() != step.max():
                    break
                depth += 1
            order = np.argsort(step, kind="stable")
            docs, step = docs[order], step[order]
            edges = np.concatenate(([0], np.flatnonzero(np.diff(step)) + 1, [len(docs)])).tolist()
            small: list[np.ndarray] = []
            groups: list[tuple[np.ndarray, bool]] = []
            for a, b in zip(edges, edges[1:]):
                if step[a] < 0:  # equal term sets: leaves of like norm
                    same = docs[a:b][np.argsort(norm[docs[a:b]], kind="stable")]
                    groups += [(same[i : i + LEAF_DOCS], False) for i in range(0, len(same), LEAF_DOCS)]
                elif b - a > LEAF_DOCS:
                    groups.append((docs[a:b], True))
                else:
                    if sum(map(len, small)) + b - a > LEAF_DOCS:
                        groups.append((np.concatenate(small), False))
                        small = []
                    small.append(docs[a:b])
            if small:
                groups.append((np.concatenate(small), False))
            for group, deeper in groups:
                self.children[node].append(len(held))
                self.children.append([])
                if deeper:
                    pending.append((len(held), group, depth + 1))
                held.append(None if deeper else group)
        return held

    def _run(self, first: int, last: int) -> tuple[int, int]:
        """The run of counts of the documents first to last - 1."""
        return int(self.starts[first]) if first < len(self.starts) else len(self.term), int(self.starts[last]) if last < len(self.starts) else len(self.term)

    def best(self, places: np.ndarray, weights: np.ndarray, k: int, kept: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best documents here and among those kept, best first."""
        bounds = (self.bound[:, places] * weights).sum(axis=1).tolist()
        weight = np.zeros(self.width, np.int64)
        weight[places] = weights
        score, doc = kept
        least = int(score[k - 1]) if len(score) >= k else 1
        pending = [0]
        while pending:
            node = pending.pop()
            if bounds[node] < least:
                continue
            if (leaf := self.leaves[node]) is None:
                pending += sorted((c for c in self.children[node] if bounds[c] >= least), key=bounds.__getitem__)
                continue
            first, last = leaf
            if first == last:
                continue
            a, b = self._run(first, last)
            scores = np.add.reduceat(weight[self.term[a:b]] * self.impact[a:b], self.starts[first:last] - a)
            good = np.flatnonzero(scores >= least)
            if len(good):
                score, doc = np.concatenate((score, scores[good])), np.concatenate((doc, self.ids[first:last][good]))
                order = np.lexsort((doc, -score))[:k]
                score, doc = score[order], doc[order]
                least = int(score[k - 1]) if len(score) >= k else 1
        return score, doc


#: DuckDB twin of the registered query.
SEARCH_SQL = r"""
WITH lists AS (
  SELECT doc_id, row_number() OVER () AS place, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms FROM documents
), sized AS (SELECT doc_id, place, terms, len(terms) AS n FROM lists WHERE len(terms) > 0),
stats AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
wanted AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark)
), held AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM sized) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, stats GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id, place, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN sized USING (place), stats GROUP BY ALL
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, place) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""
