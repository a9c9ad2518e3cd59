"""Near-duplicate documents: banded MinHash, sequential Bayesian pruning, exact verification.

1. One pass over the texts gives each row the digest of its word sequence (equal sequences form one class, led by its
   smallest id), the size of its set of five-word shingles and 256 minimum hashes.
2. Class leaders fall into 51 bands of five hashes. A pair of Jaccard similarity 0.75 misses all of them
   with probability (1 - 0.75^5)^51 < 1e-6.
3. In each bucket everything is first compared with one hub, the smallest id: as many pairs as rows, whatever the bucket's size.
   Once these links are joined into components, only pairs of one bucket that lie in different components are left, and all
   of them are compared: no cap, no sampling, and no pairs inside a group of copies.
4. A comparison reads the signatures in batches of 32 hashes. After each batch it drops the pair when the posterior probability
   of a similarity at or above the limit (uniform prior) is under `miss`. Survivors are verified on their full sets: first each
   document with its likeliest hub, then all documents with open pairs between two components, in blocks (`blocks.py`).

Defined cases: rows are nodes. A null text, or a text without words, is an empty set linked with nothing: its component is its
own id. Fewer than five words are one shingle. A row with a null id takes no part and comes back with a null component, kept.
Repeated rows come back as often as they are given, all in one component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorwatch.llm.blocks import groups, in_blocks
from sensorwatch.llm.common import components, gram_hashes, mixed, staged, text_batches, word_hashes, word_list

SHINGLE, PERCENT = 5, 75
HASHES, ROWS, BATCH = 256, 5, 32
BANDS = HASHES // ROWS
MISS = 1e-6
BLOCK = 1024


@lru_cache(1)
def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    draw = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
    return (draw[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (draw[HASHES:] >> np.uint64(32)).astype(np.uint32)


def _signature(shingles: np.ndarray) -> bytes:
    """Low halves of the smallest values of 256 affine maps of 32-bit shingle hashes."""
    a, b = _coefficients()
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(x), 512):
        part = x[start : start + 512]
        low = np.minimum(low, (a[:, None] * part[None, :] + b[:, None]).min(axis=1))
    low ^= low >> np.uint32(15)  # the smallest values of long texts share their leading bits
    return (low & np.uint32(0xFFFF)).astype("<u2").tobytes()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches):
        keys, sizes, signatures = [], [], []
        for text in batch.column(1).to_pylist():
            words = word_list(text)
            shingles = np.unique(gram_hashes(word_hashes(words), SHINGLE))
            keys.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
            sizes.append(len(shingles))
            signatures.append(_signature(shingles) if words else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())], names=["id", "cls", "size", "signature"]
        )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket for each band of each leader."""
    for batch in text_batches(batches, 4096):
        values = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, HASHES)[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
        bucket = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), values.shape[:2]).copy()
        with np.errstate(over="ignore"):
            for k in range(ROWS):
                bucket = mixed(bucket * np.uint64(0x9E3779B97F4A7C15) + values[:, :, k])
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(bucket.reshape(-1).view(np.int64)), pa.array(ids)], names=["bucket", "id"])


@lru_cache(8)
def least_matches(miss: float = MISS, limit: float = PERCENT / 100) -> tuple[int, ...]:
    """For each number of hashes compared: the fewest matches whose posterior chance of a similarity >= limit is at least `miss`."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    least = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            density = m * np.log(grid) + (n - m) * np.log1p(-grid) + lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1)
            if np.exp(density)[grid >= limit].mean() * (1 - limit) >= miss:
                break
        least.append(m)
    return tuple(least)


def _prune(percent: int, miss: float):
    least = least_matches(miss, percent / 100)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 8192):
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, HASHES) for k in (2, 3))
            alive, matches = np.arange(len(one)), np.zeros(len(one), np.int64)
            for step, low in enumerate(least):
                part = slice(step * BATCH, (step + 1) * BATCH)
                matches[alive] += (one[alive, part] == two[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= low]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(alive)), batch.column(1).take(pa.array(alive)), pa.array(matches[alive])], names=["a", "b", "matches"])

    return prune


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches):
        shingles = [np.unique(gram_hashes(word_hashes(word_list(t)), SHINGLE)).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shingles, pa.binary())], names=["id", "shingles"])


class Union:
    """Union-find over the components of a block: `join` says whether it has merged two."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(above, above)
            x = above
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links between components of a block that the full sets of a left and a right row prove; as many as join them, no more."""
        for table in groups(batches):
            ids, sides, of = (table.column(c).to_numpy() for c in ("id", "side", "component"))
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
            sizes = np.array([len(sets[k]) for k in right])
            values = np.concatenate([sets[k] for k in right])
            order = np.argsort(values, kind="stable")
            values, owners = values[order], np.repeat(np.arange(len(right)), sizes)[order]
            a, b, union = [], [], Union()
            for k in left:
                low, high = np.searchsorted(values, sets[k], "left"), np.searchsorted(values, sets[k], "right")
                n = high - low
                spots = np.arange(n.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
                shared = np.bincount(owners[spots], minlength=len(right))
                linked = right[(100 * shared >= percent * (len(sets[k]) + sizes - shared)) & (of[right] != of[k])]
                for t in linked[np.unique(of[linked], return_index=True)[1]]:
                    if union.join(int(of[k]), int(of[t])):
                        a.append(ids[k])
                        b.append(ids[t])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return verify


def _compare(percent: int, miss: float):
    least = least_matches(miss, percent / 100)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For a block of a bucket: the leaders with an open pair (id, component), and as many pairs of components as join those that hold one."""
        for table in groups(batches):
            ids, sides, of = (table.column(c).to_numpy() for c in ("id", "side", "component"))
            size = table.column("size").to_numpy()
            signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u2").reshape(-1, HASHES)
            right = np.flatnonzero(sides == 1)
            active, pairs, union = {}, [], Union()
            for k in np.flatnonzero(sides == 0):
                alive = right[(of[right] != of[k]) & (100 * np.minimum(size[right], size[k]) >= percent * np.maximum(size[right], size[k]))]
                matches = np.zeros(len(alive), np.int64)
                for step, low in enumerate(least):
                    part = slice(step * BATCH, (step + 1) * BATCH)
                    matches += (signs[alive, part] == signs[k, part]).sum(axis=1)
                    alive, matches = alive[matches >= low], matches[matches >= low]
                if len(alive):
                    active[int(ids[k])] = int(of[k])
                    active.update(zip(ids[alive].tolist(), of[alive].tolist()))
                    pairs += [(False, int(of[k]), c) for c in np.unique(of[alive]).tolist() if union.join(int(of[k]), c)]
            rows = [(True, *x) for x in active.items()] + pairs
            if rows:
                kind, x, y = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.bool_()), pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["is_id", "x", "y"])

    return compare


def _survivors(pairs: DataFrame, leaders: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs (a < b) that outlive the size bound and the signature batches, with their matches."""
    one = leaders.select(F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("signature").alias("signature_a"))
    two = leaders.select(F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("signature").alias("signature_b"))
    near = pairs.join(one.select("a", "size_a"), "a").join(two, "b").where(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    near = near.select("a", "b", "signature_b").join(one.select("a", "signature_a"), "a").select("a", "b", "signature_a", "signature_b")
    return near.mapInArrow(_prune(percent, miss), "a long, b long, matches long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """id, n_shingles, component_id and kept of each row of docs."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = staged(texts.mapInArrow(_describe, "id long, cls binary, size long, signature binary"), "signatures")
    lead = rows.where("cls is not null and id is not null").groupBy("cls").agg(F.min("id").alias("leader"))
    of = lead.select(F.col("cls").alias("own"), F.col("leader").alias("id"))
    leaders = rows.join(of, "id").where("cls = own").dropDuplicates(["id", "cls"]).select("id", "size", "signature")
    leaders = staged(leaders, "leaders")
    links = _links(texts, leaders, percent, miss)
    joined = components(links).withColumnsRenamed({"node": "leader", "component": "found"})
    classes = lead.join(joined, "leader", "left").select("cls", F.coalesce("found", "leader").alias("found"))
    out = rows.select("id", "cls", "size").join(classes, "cls", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("found", "id"))
    return out.select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def _links(texts: DataFrame, leaders: DataFrame, percent: int, miss: float) -> DataFrame:
    """Verified links between class leaders that give the same components as all links."""
    bands = leaders.select("id", "signature").mapInArrow(_bands, "bucket long, id long")
    hubs = bands.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").drop("last")
    # Rows of buckets with several leaders: all that later steps need of the bands.
    shared = staged(bands.join(hubs, "bucket").select("bucket", "id", "hub"), "buckets")
    candidates = _survivors(shared.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), leaders, percent, miss)
    best = candidates.groupBy("b").agg(F.max_by("a", F.struct("matches", -F.col("a"))).alias("a"))
    best = staged(best.select(F.col("a").alias("key"), F.col("b").alias("id")), "best")
    sets = SetStore(texts)
    hub = F.col("key").alias("id"), F.col("key").alias("component")
    first = sets.linked(best.withColumn("component", F.col("id")), best.select("key", *hub).distinct(), percent)
    of = components(first)
    # What is left: pairs of one bucket in different components. Most buckets hold one component and end here.
    member = shared.join(of.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    number = member.groupBy("bucket", "component").count()
    split = number.groupBy("bucket").agg(F.max_by("component", F.struct("count", -F.col("component"))).alias("main"), F.count("*").alias("n")).where("n > 1").select("bucket", "main")
    member = staged(member.join(split, "bucket").select(F.col("bucket").alias("key"), "id", "component", "main"), "split")
    blocks = in_blocks(member.where("component <> main").drop("main"), member.drop("main"), BLOCK, leaders)
    found = staged(blocks.mapInArrow(_compare(percent, miss), "is_id boolean, x long, y long").distinct(), "open")
    active = found.where("is_id").select(F.col("x").alias("id"), F.col("y").alias("component"))
    # Components that open pairs connect are verified together: all but those of the largest one against all.
    together = components(found.where("not is_id"), "x", "y").select(F.col("node").alias("component"), F.col("component").alias("key"))
    active = staged(active.join(together, "component").select("key", "id", "component"), "active")
    number = active.groupBy("key", "component").count()
    main = number.groupBy("key").agg(F.max_by("component", F.struct("count", -F.col("component"))).alias("main"))
    return first.unionByName(sets.linked(active.join(main.hint("rebalance"), "key").where("component <> main").drop("main"), active, percent))


class SetStore:
    """Shingle sets of the documents that some comparison needs, each computed once."""

    def __init__(self, texts: DataFrame):
        self.texts, self.sets = texts, None

    def linked(self, left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
        ids = left.select("id").unionByName(right.select("id")).distinct()
        if self.sets is not None:
            ids = ids.join(self.sets, "id", "left_anti")
        ids = staged(ids, "wanted")  # a table of known size: while it is small, Spark broadcasts it and leaves the texts where they are
        found = staged(self.texts.join(ids, "id", "left_semi").dropDuplicates(["id"]).mapInArrow(_sets, "id long, shingles binary"), "sets")
        self.sets = found if self.sets is None else self.sets.unionByName(found)
        return staged(in_blocks(left, right, BLOCK, self.sets).mapInArrow(_verify(percent), "a long, b long"), "verified")
