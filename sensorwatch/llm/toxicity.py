"""Toxicity after noisy-channel deobfuscation.

Writers hide words behind look-alike characters (1d10t), repeated letters (idiooot) and spacing (i d i o t). A disguised token is seen
as the output of a noisy channel: each of its characters opens a few letters it may stand for, at a channel cost, a run of one letter may
stand for one or two, and a separator between single letters may stand for nothing. Viterbi's algorithm finds the likeliest letters of
this lattice under a character trigram model. A plain word has a lattice of one path, itself, and is not decoded.

* The character model counts all trigrams of all texts of the corpus. Its alphabet is fixed (a-z, the small letters U+00DF to U+00FF,
  one symbol for other letters, one for everything else), so its table has a proven size, 64^3 numbers.
* Evidence: each restored word, and each prefix of four or five letters, is a feature, whose log odds come from the number of toxic and of
  other labelled documents holding it. A document's score is a logistic function of its three strongest words. Half of the labelled
  documents weigh the features, the other half fits the logistic function; the weights are then taken anew from both halves.
* The classifier learns from at most MAX_LABELLED labelled documents, taken by a hash of their ids, and keeps at most MAX_FEATURES features.
  Both bounds are parameters. Everything else covers all documents.

Defined cases: a null or empty text, or one without words, has the score of a document without evidence. Documents without a label, with a
null label or several labels: only labels 0 and 1 count; of several the larger one. Repeated rows are scored as often as they are given. A null
id is scored, and is never learned from. Without any labels of both kinds every score is the share of toxic labels (0 with none).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwatch.llm.common import text_batches

MAX_LABELLED, MAX_FEATURES = 200_000, 65_536
THRESHOLD = 0.3
CODES = 64
OTHER_LETTER, OUTSIDE = 60, 0
CACHED_TOKENS = 400_000

#: Characters in use for look-alike letters.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Channel costs in nats: a look-alike, leaving out a separator, leaving out repeated letters, and a mark that stands for itself.
SWAP, JOIN, SQUEEZE, MARK = 1.5, 0.5, 1.0, 4.0

_LETTER = r"[^\W\d_]"
_SPACED = re.compile(rf"(?<!\S)(?:{_LETTER}|[0-9@$!|+])(?:[ .\-_*]+(?:{_LETTER}|[0-9@$!|+])){{2,}}(?![^\s.,;:!?])")
_LETTERS, _RUN = re.compile(_LETTER + "+"), re.compile(r"(.)\1\1")
_CLOSING, _OPENING = ".,;:!?\"')]%*&", "\"'(["
_EDGES = re.compile(r"^[^\w@$!|+(€£¡]+|[^\w@$]+$")
_DISGUISED = re.compile(rf"{_LETTER}[^\s]*[0-9@$!|+(€£¡*_.\-]|[0-9@$!|+(€£¡][^\s]*{_LETTER}|({_LETTER})\1\1")


# ---- character model


@lru_cache(1)
def _code_table() -> np.ndarray:
    table = np.zeros(0x10000, np.uint8)
    for n in range(0x80, 0x10000):
        if chr(n).isalpha():
            table[n] = OTHER_LETTER
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[ord("A") : ord("Z") + 1] = np.arange(1, 27)
    for n in range(0xDF, 0x100):
        if chr(n).isalpha():
            table[n] = 27 + n - 0xDF
            upper = chr(n).upper()
            if len(upper) == 1 and ord(upper) < 0x10000:
                table[ord(upper)] = table[n]
    return table


@lru_cache(1)
def _code_list() -> list[int]:
    return _code_table().tolist()


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _code_table()[np.minimum(points, 0xFFFF)]


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CODES**3, np.int64)
    for batch in text_batches(batches):
        line = codes("\n\n".join(["", *(t for t in batch.column(0).to_pylist() if t), ""])).astype(np.int32)
        if len(line) > 2:
            total += np.bincount((line[:-2] * CODES + line[1:-1]) * CODES + line[2:], minlength=CODES**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of the 64^3 possible trigrams over all texts."""
    rows = docs.select(text_col).mapInArrow(_count_trigrams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(CODES**3)
    counts[rows.gram.to_numpy()] = rows.n.to_numpy()
    return counts.reshape(CODES, CODES, CODES)


def character_model(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), interpolated with shorter contexts."""
    single = counts.sum(axis=(0, 1)) + 0.5
    single /= single.sum()
    pair = counts.sum(axis=0)
    pair = (pair + 5 * single) / (pair.sum(axis=1, keepdims=True) + 5)
    triple = (counts + 5 * pair) / (counts.sum(axis=2, keepdims=True) + 5)
    return (-np.log(triple)).astype(np.float32)


# ---- decoding


def lattice(token: str, spaced: bool) -> list[list[tuple[str, float]]]:
    """For each stretch of the token, the letters it may stand for (one stretch may give none or two) with their channel cost."""
    out: list[list[tuple[str, float]]] = []
    at = 0
    while at < len(token):
        c = token[at]
        run = 1
        while at + run < len(token) and token[at + run] == c:
            run += 1
        if c.isalpha():
            ways = [(c * run, 0.0)]
            if run >= 3 or spaced and run == 2:
                ways = [(c * run, 0.0), (c, SQUEEZE), (c * 2, SQUEEZE)] if run > 2 else [(c * 2, 0.0), (c, SQUEEZE)]
        elif c in LOOKALIKES:
            ways = [(x * k, SWAP * k) for x in LOOKALIKES[c] for k in {1, min(run, 2)}] + [(" ", MARK)]
        else:
            ways = [("", JOIN), (" ", SQUEEZE if spaced else JOIN)]
        out.append(ways)
        at += run
    return out


def decode(token: str, model: np.ndarray | list, spaced: bool = False) -> str:
    """The likeliest letters of the token's lattice, blanks where marks stand for themselves. A model as nested lists is read faster."""
    table, costs = _code_list(), model if isinstance(model, list) else model.tolist()
    best: dict[tuple[int, int], tuple[float, tuple]] = {(OUTSIDE, OUTSIDE): (0.0, ())}
    for ways in [*lattice(token, spaced), [(" ", 0.0)]]:
        following: dict[tuple[int, int], tuple[float, tuple]] = {}
        for letters, cost in ways:
            steps = [table[min(ord(c), 0xFFFF)] for c in letters]
            for (a, b), (before, path) in best.items():
                total = before + cost
                for c in steps:
                    total += costs[a][b][c]
                    a, b = b, c
                if (a, b) not in following or total < following[a, b][0]:
                    following[a, b] = (total, (path, letters))
        best = following
    path, out = min(best.values(), key=lambda x: x[0])[1], []
    while path:
        path, letters = path
        out.append(letters)
    return "".join(reversed(out)).strip()


# ---- features


def _word_features(word: str) -> list[str]:
    return [word, "^" + word[:4], "^" + word[:5]] if len(word) >= 5 else [word, "^" + word] if len(word) == 4 else [word]


class Reader:
    """What a text's tokens are worth. Each token is read once and then known; tokens of no worth are only remembered as seen."""

    def __init__(self, model: np.ndarray, value):
        """value: of a list of features, what is kept for a token; empty or zero for nothing."""
        self.model, self.value = model.tolist(), value
        self.known: dict[str, object] = {}
        self.seen: set[str] = set()

    def _read(self, token: str):
        plain = token.rstrip(_CLOSING).lstrip(_OPENING)
        if plain.isalpha() and not _RUN.search(plain):
            return self.value(_word_features(plain)) if len(plain) >= 3 else None
        plain = _EDGES.sub("", token)
        words = decode(plain, self.model).split() if _DISGUISED.search(plain) else _LETTERS.findall(plain)
        return self._worth(words)

    def _worth(self, words: list[str]):
        return self.value([f for w in words if len(w) >= 3 for f in _word_features(w)])

    def values(self, text: str | None) -> list:
        tokens = (text or "").lower().split()
        found = set(tokens)
        new = found - self.seen
        if len(self.seen) + len(new) > CACHED_TOKENS:
            self.seen, self.known, new = set(), {}, found
        out = []
        for token in new:
            got = self._read(token)
            if len(token) >= 64:
                out += [got] if got else []
                continue
            self.seen.add(token)
            if got:
                self.known[token] = got
        out += [self.known[token] for token in self.known.keys() & found]
        if min(map(len, found), default=2) == 1 and _SPACED.search(text := " ".join(tokens)):
            worth = [self._worth(decode(x, self.model, spaced=True).split()) for x in set(_SPACED.findall(text))]
            out += [x for x in worth if x]
        return out


def _hash(features: list[str]) -> tuple[int, ...]:
    return tuple(xxhash.xxh3_64_intdigest(f) >> 1 for f in features)


# ---- learning


def crc_mod4(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4))


def training_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", bound: int = MAX_LABELLED) -> DataFrame:
    """(id, toxic, half) of the labelled documents to learn from: not in the held-out fold, and at most `bound` of them by a hash."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (crc_mod4(id_col) != 2))
    rows = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    draw = F.xxhash64("id", F.lit("draw"))
    share = min(1.0, 0.98 * bound / max(1, rows.count()))
    return rows.where(F.pmod(draw, F.lit(1_000_000)) < int(share * 1_000_000)).withColumn("half", (F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2))).cast("int")).limit(bound)


def _count_features(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value, _hash)
        counts = [Counter() for _ in range(4)]

        def rows():
            for kind, c in enumerate(counts):
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array(c.keys(), pa.int64()), pa.array(np.full(len(c), kind, np.int32)), pa.array(c.values(), pa.int64())], names=["feature", "kind", "n"])
                    c.clear()

        for batch in text_batches(batches):
            for text, toxic, half in zip(*(batch.column(k).to_pylist() for k in range(3))):
                counts[2 * half + toxic].update({f for token in reader.values(text) for f in token})
            if sum(map(len, counts)) > 1_000_000:
                yield from rows()
        yield from rows()

    return count


def _weights(table, positive: int, negative: int, toxic: str, other: str) -> dict[int, float]:
    """Log odds of the features that at least two toxic documents hold, less for rare ones; the strongest ones only."""
    p, n = table[toxic].to_numpy(float), table[other].to_numpy(float)
    odds = np.log((p + 0.5) / (positive + 1)) - np.log((n + 0.5) / (negative + 1)) - 2 / np.sqrt(p + 0.5)
    at = np.flatnonzero((p >= 2) & (odds > 1))
    at = at[np.argsort(-odds[at], kind="stable")][:MAX_FEATURES]
    return dict(zip(table.feature.to_numpy()[at].tolist(), odds[at].tolist()))


def _largest(weights: dict[int, float]):
    """The largest weight of a list of features. Prefixes, of which there are few, are hashed once."""
    prefixes: dict[str, float] = {}

    def largest(features: list[str]) -> float:
        best = 0.0
        for f in features:
            got = prefixes.get(f)
            if got is None:
                got = weights.get(xxhash.xxh3_64_intdigest(f) >> 1, 0.0)
                if f[0] == "^":
                    prefixes[f] = got
            if got > best:
                best = got
        return best

    return largest


def _strongest(shared, extra: int):
    """Batches (text, ...) -> the other columns and the three largest token weights."""

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weights = shared.value
        reader = Reader(model, _largest(weights))
        for batch in text_batches(batches):
            top = np.zeros((batch.num_rows, 3))
            for k, text in enumerate(batch.column(0).to_pylist()):
                found = sorted((w for w in reader.values(text) if w), reverse=True)[:3]
                top[k, : len(found)] = found
            yield pa.RecordBatch.from_arrays([*(batch.column(1 + k) for k in range(extra)), *(pa.array(top[:, k].copy()) for k in range(3))], names=[*batch.schema.names[1:], "w1", "w2", "w3"])

    return strongest


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's steps; the weights of evidence are kept from being negative."""
    keep = [0, 1, 2, 3]
    x = np.column_stack([np.ones(len(x)), x / 10])
    while True:
        beta, a = np.zeros(4), x[:, keep]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ beta[keep], -30, 30)))
            penalty = 0.05 * np.eye(len(keep))
            penalty[0, 0] = 1e-6
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ beta[keep])
            beta[keep] += step
            if np.abs(step).max() < 1e-8:
                break
        worst = min(keep[1:], key=lambda k: beta[k], default=0)
        if not worst or beta[worst] >= 0:
            return beta / np.array([1, 10, 10, 10])
        keep.remove(worst)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """id, held_out, score and predicted of each row of docs."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    model = character_model(trigram_counts(docs, text_col))
    marked = F.broadcast(training_labels(labels, id_col, label_col))  # at most MAX_LABELLED rows of 16 bytes
    learned = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id")).join(marked, "id").select("text", "toxic", "half")
    counted = learned.mapInArrow(_count_features(share(model)), "feature long, kind int, n long").groupBy("feature")
    of = lambda *kinds: F.sum(F.when(F.col("kind").isin(*kinds), F.col("n")).otherwise(0))
    table = counted.agg(of(1).alias("toxic0"), of(0).alias("other0"), of(1, 3).alias("toxic"), of(0, 2).alias("other")).where("toxic >= 2 and toxic > other / 4")
    table = table.orderBy(F.desc(F.col("toxic") / (F.col("other") + 1)), "feature").limit(MAX_FEATURES).toPandas()
    sizes = {(r["toxic"], r["half"]): r["count"] for r in learned.groupBy("toxic", "half").count().collect()}
    size = lambda toxic, *halves: sum(sizes.get((toxic, h), 0) for h in halves)
    if size(1, 0, 1) and size(0, 0, 1):
        first = _weights(table, size(1, 0), size(0, 0), "toxic0", "other0")
        fit = learned.where("half = 1").select("text", F.col("toxic").cast("int").alias("toxic"))
        fit = fit.mapInArrow(_strongest(share((model, first)), 1), "toxic int, w1 double, w2 double, w3 double").toPandas()
        beta = _logistic(fit[["w1", "w2", "w3"]].to_numpy(), fit.toxic.to_numpy(float)) if fit.toxic.nunique() == 2 else np.array([-4.0, 1.0, 0.0, 0.0])
        weights = _weights(table, size(1, 0, 1), size(0, 0, 1), "toxic", "other")
    else:
        part = size(1, 0, 1) / max(1, size(1, 0, 1) + size(0, 0, 1))
        beta, weights = np.array([np.log(part / (1 - part)) if 0 < part < 1 else 40 * part * 2 - 40, 0, 0, 0]), {}
    scored = docs.select(F.col(text_col), F.col(id_col)).mapInArrow(_strongest(share((model, weights)), 1), f"{id_col} {docs.schema[id_col].dataType.simpleString()}, w1 double, w2 double, w3 double")
    total = sum((F.lit(float(b)) * F.col(f"w{k}") for k, b in enumerate(beta) if k), F.lit(float(beta[0])))
    scored = scored.withColumn("score", 1 / (1 + F.exp(-total)))
    return scored.select(id_col, F.coalesce(crc_mod4(id_col) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def crc_of(value: int) -> int:
    """The fold number of an id, as crc_mod4 gives it."""
    return zlib.crc32(str(value).encode()) % 4
