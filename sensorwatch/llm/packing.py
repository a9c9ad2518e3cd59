"""Best-fit packing of token pieces after Martello-Toth dominance reduction.

Documents are tokenised once, where they lie; only a longer one than a sequence is cut. What a packing needs to know is the number
of pieces of each length, at most `capacity` numbers whatever the corpus, so the plan is made on them:

1. dominance reduction (Martello and Toth, 1990): a set of at most three pieces that contains the largest one left and dominates
   every other feasible set containing it is fixed as a sequence for good, for as many copies at once as there are; so full pieces,
   exact pairs, and pieces beside which only one or two others fit leave the instance;
2. best fit, longest first, of the remainder: a piece goes where least room stays.

The plan is a list of runs: pieces of one length, numbered from r, go to sequences s, s+1, ... at one offset. Spark numbers the pieces
of each length (in hashed parts, so that a length held by very many pieces is no single task) and looks their places up in the runs.

Defined cases: a null or empty text has only the closing id 0. Repeated rows are packed as often as they are given. A null id is packed
like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import importlib
import json
import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorwatch.llm.common import staged, text_batches

CAPACITY, END_ID = 2048, 0
CACHED_WORDS = 400_000
PARTS = 1024


def tokenizer_file(name: str = "byte_bpe_50k.tiktoken", package: str = "public_tokenizers") -> str:
    """The place of a vocabulary file of the installed public tokenizers."""
    return importlib.import_module(package).path(name)


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes.

    This vocabulary never merges across a space that a non-blank character follows: such a space opens the next word. So a text
    is cut there, and each word, with the space before it, is encoded once and looked up afterwards. Special tokens of the vocabulary, which its
    .json file beside the ranks names, are found in the text first; what lies between them is encoded by itself.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words: dict[str, bytes] = {}
        self.special: dict[str, bytes] = {}
        named = Path(path).with_suffix(".json")
        if named.exists():
            added = json.loads(named.read_text(encoding="utf-8"))["added_tokens"]
            self.special = {t["content"]: np.uint32(t["id"]).tobytes() for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.parted = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

    def _bytes(self, text: str) -> bytes:
        return np.asarray(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.parted and any(t in text for t in self.special):
            return b"".join(self.special[part] if part in self.special else self._plain(part) for part in self.parted.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        first, *words = text.split(" ")
        if any(not w or w[0].isspace() for w in words):
            words, rest = [first], words
            for w in rest:  # blanks beside a space belong to what stands before them
                if w and not w[0].isspace():
                    words.append(w)
                else:
                    words[-1] += " " + w
            first, *words = words
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        return self._bytes(first) + b"".join(map(self._word, words))

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            got = self._bytes(" " + word)
            if len(word) < 64:
                self.words[word] = got
        return got


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(path: str, capacity: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        end = np.uint32(END_ID).tobytes()
        for batch in text_batches(batches):
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                n, start, piece = len(ids) // 4, 0, 0
                length = n % capacity or capacity  # the first piece may be shorter, all others are full
                while start < n:
                    rows.append((name, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    start, piece, length = start + length, piece + 1, capacity
            yield pa.RecordBatch.from_pylist([dict(zip(PIECE.names, r)) for r in rows], PIECE)

    return pieces


PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


# ---- the plan, over numbers of pieces by length


class Plan:
    def __init__(self, numbers: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = {n: k for n, k in numbers.items() if k}
        self.used: dict[int, int] = defaultdict(int)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0

    def place(self, length: int, count: int, sequence: int, offset: int) -> None:
        """The next `count` pieces of a length go to as many sequences, each at `offset`."""
        self.runs.append((length, self.used[length], count, sequence, offset))
        self.used[length] += count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]

    def fix(self, lengths: list[int], count: int) -> None:
        offset = 0
        for n in lengths:
            self.place(n, count, self.sequences, offset)
            offset += n
        self.sequences += count

    def reduce(self) -> int:
        """Fix dominating sets while there are any, from the largest piece on. The number of sequences fixed."""
        before, at = self.sequences, -1
        while at != self.sequences:
            at = self.sequences
            for largest in sorted(self.left, reverse=True):
                while largest in self.left and (found := self._dominating(largest)):
                    self.fix(found, min(self.left[n] // found.count(n) for n in found))
        return self.sequences - before

    def _dominating(self, largest: int) -> list[int] | None:
        """A set with a piece of length `largest` that dominates all feasible sets with it, or None."""
        room = self.capacity - largest
        count = lambda n: self.left[n] - (n == largest)
        others = sorted(n for n in self.left if n <= room and count(n) > 0)
        if not others:
            return [largest]
        best = others[-1]
        if best == room:
            return [largest, best]
        left, k = room, 0
        for n in others:  # how many others fit at most
            take = min(count(n), left // n, 3 - k)
            left, k = left - n * take, k + take
            if k >= 3 or not take:
                break
        if k == 1:
            return [largest, best]
        if k == 2:
            pair, low = (0, 0, 0), 0
            high = len(others) - 1
            while low <= high:
                total = others[low] + others[high]
                if total > room or (low == high and count(others[low]) < 2):
                    high -= 1
                    continue
                pair = max(pair, (total, others[low], others[high]))
                low += 1
            if best >= pair[0]:
                return [largest, best]
            if pair[0] == room and best == pair[2] and self._single_gap(others, pair):
                return [largest, pair[2], pair[1]]
        return None

    @staticmethod
    def _single_gap(others: list[int], pair: tuple[int, int, int]) -> bool:
        """The pair fills the room with the largest fitting piece, and no length lies between its two."""
        return bisect_left(others, pair[2]) - bisect_left(others, pair[1]) <= 1

    def best_fit(self) -> None:
        """Longest first; equal open sequences are kept as one class (first sequence, count)."""
        open_by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)
        rooms: list[int] = []

        def add(room: int, sequence: int, count: int) -> None:
            if room:
                if not open_by_room[room]:
                    at = bisect_left(rooms, room)
                    rooms.insert(at, room)
                open_by_room[room].append((sequence, count))

        for n in sorted(self.left, reverse=True):
            while n in self.left:
                at = bisect_left(rooms, n)
                if at == len(rooms):
                    per = min(self.capacity // n, self.left[n])
                    bins = self.left[n] // per
                    for k in range(per):
                        self.place(n, bins, self.sequences, k * n)
                    add(self.capacity - per * n, self.sequences, bins)
                    self.sequences += bins
                    continue
                room = rooms[at]
                sequence, count = open_by_room[room].pop()
                if not open_by_room[room]:
                    rooms.pop(at)
                per = min(room // n, self.left[n])
                bins = min(count, self.left[n] // per)
                for k in range(per):
                    self.place(n, bins, sequence, self.capacity - room + k * n)
                if bins < count:
                    add(room, sequence + bins, count - bins)
                add(room - per * n, sequence, bins)


def make_plan(numbers: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan = Plan(numbers, capacity)
    plan.reduce()
    plan.best_fit()
    return plan


# ---- the job


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of each piece of each row."""
    rows = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_pieces(tokenizer_file(vocabulary), capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")
    return place(staged(rows, "pieces"), capacity)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset, by their `length` alone."""
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(PARTS)).cast("int")
    numbers = pieces.groupBy("length", part.alias("part")).count()
    numbers = staged(numbers, "numbers")
    plan = make_plan({r[0]: r[1] for r in numbers.groupBy("length").sum("count").collect()}, capacity)
    runs = {}
    for length, first, count, sequence, offset in plan.runs:
        runs.setdefault(length, []).append((first, sequence, offset))
    shared = pieces.sparkSession.sparkContext.broadcast({n: np.array(sorted(x), np.int64).T for n, x in runs.items()})

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                if len(at):
                    first, sequences, offsets = shared.value[lengths[at[0]]]
                    run = np.searchsorted(first, ranks[at], "right") - 1
                    sequence[at], offset[at] = sequences[run] + ranks[at] - first[run], offsets[run]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(5)), pa.array(sequence), pa.array(offset)], names=[*PIECE.names, "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = numbers.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece")) - 1
    ranked = pieces.withColumn("part", part).withColumn("within", within).join(base, ["length", "part"])
    ranked = ranked.select(*PIECE.names, (F.col("within") + F.col("base")).cast("long").alias("rank"))
    return ranked.mapInArrow(look_up, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
