"""Collocation mining: phrases whose words stand together far more often than their parts would by themselves, by language.

Method: each task reads its documents shard by shard (SHARD_WORDS words) and stores a shard as numbers, one for each word of each language. A
bidirectional FM-index is built over a shard's numbers: the order of the suffixes and of the reversed prefixes, with the word that stands before each
(the Burrows-Wheeler transforms), so that an interval of the one order and its twin in the other stand for all places of a phrase. Extending
an interval by a word on either side is a rank query. Beginning with single words, phrases are extended to the right and then to the left until they
have `longest` words, all intervals of a length at once; the width of an interval is the phrase's count. As no longer phrases are asked for, suffixes are
ordered by that many words only, which leaves all intervals the same. Shards return their counts, and Spark sums them by phrase. A phrase's left and
right extensions in the summed table decide whether a longer candidate holds most of its places.

Lengths are counted one after the other, for a phrase is frequent only if both phrases of one word less in it are. Shards learn these by a bitmap of
BITMAP_BITS hashed bits, whatever the number of frequent phrases. A bit that several phrases share lets rare phrases through to be counted, never the other way
round, so results do not depend on it.

Rules: A-Z are lowered, `.,;:!?` and U+000A to U+000D end a piece, blanks and tabs part words, and phrases lie within a piece. A candidate has
`shortest` to `longest` words and `least` places or more. Cut after its first k words, it scores floor(1000000 a a / (l r)); its lowest cut
counts (the smallest k of equal ones). Candidates inside a longer one that has half of their places or more go. Each language returns its first `top` by
score, places and phrase. All arithmetic is in whole numbers, the products in 38 digits.

Hot words: a shard hands on one row for each phrase it holds, so the commonest word of the commonest language is one row for each shard.

Odd input: null and empty texts have no words. A null language counts as `und`, together with the value `und`. Very long texts are read in pieces; a
shard ends where a text ends. Repeated documents count each time. Languages without candidates return no row, and an empty table returns
none. Equal scores and counts are told apart by the phrase in byte order. Other columns, whatever their names, have no influence.
"""

from __future__ import annotations

import itertools
import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorwatch.llm.common import staged, union_all

# Executors need not have this package: the functions of this module travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD_WORDS = 1 << 21
#: Places of the single words from which phrases are extended at a time.
SLICE_PLACES = 1 << 18
#: A longer text is split into words piece by piece.
PIECE_BYTES = 1 << 20
#: A-Z lowered; what ends a piece becomes a line end, a tab a blank.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
#: Bits by which shards know the frequent phrases of a length: 8 MB.
BITMAP_BITS = 1 << 26
SHARDS = "words array<binary>, langs array<int>, names array<string>, text binary"
#: key: language, tab, phrase (no word holds a tab); the phrase is empty in the row of a language's number of words.
COUNTS = "key string, places long"


def collocations(docs: DataFrame, shortest: int = 2, longest: int = 3, least: int = 10, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language. docs: text, lang."""
    counted = frequent_phrases(docs, longest, least)
    totals = counted.where("words = 0").select("lang", F.col("places").alias("n"))
    grams = counted.where("words > 0")
    candidates = grams.where(F.col("words") >= shortest).withColumn("_w", F.split("phrase", " "))
    kept = candidates.join(_absorbed(candidates, shortest), ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("places"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    scored = _scored(kept, grams).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return scored.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def frequent_phrases(docs: DataFrame, longest: int, least: int) -> DataFrame:
    """lang, phrase, words, places of all phrases of up to `longest` words with `least` places, and the empty phrase of 0 words with a language's words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    # One shard in a row group: writers and readers hold one at a time, however many a task has.
    shards = staged(texts.mapInArrow(_shard_rows, SHARDS), "shards", **{"parquet.block.row.count.limit": 1})
    found, bitmaps = [], []
    for size in range(1, longest + 1):
        counts = shards.mapInArrow(_counting(spark.sparkContext.broadcast(bitmaps), size, longest), COUNTS)
        # Shards have counted already: to combine again before the shuffle would only hash every phrase twice.
        summed = counts.repartition("key").groupBy("key").agg(F.sum("places").alias("places"))
        phrase = F.substring_index("key", "\t", -1)
        words = F.when(phrase == "", F.lit(0)).otherwise(F.lit(size))
        lang = F.expr("left(key, length(key) - length(substring_index(key, '\t', -1)) - 1)")
        kept = summed.where((F.col("places") >= least) | (phrase == "")).select(lang.alias("lang"), phrase.alias("phrase"), words.alias("words"), "places")
        found.append(staged(kept, "phrases"))
        if size < longest:
            bitmaps = [*bitmaps, _bitmap(found[-1].where("words > 0"))]
    return union_all(found)


def _bitmap(grams: DataFrame) -> np.ndarray:
    """The bits of the phrases of one length, combined by Spark; the driver gets BITMAP_BITS bits at most."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [_word_numbers(p.encode().split(b" "), [lang] * (p.count(" ") + 1)) for lang, p in zip(*(c.to_pylist() for c in batch.columns))]
            at = _bit(np.array(numbers, np.uint64).reshape(len(numbers), -1)) if numbers else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5, pa.int32()), pa.array(np.int64(1) << (at & 31))], ["word", "bits"])

    rows = grams.select("lang", "phrase").mapInArrow(places, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(BITMAP_BITS >> 5, np.uint32)
    bitmap[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return bitmap


def _word_numbers(words: list[bytes], langs: list[str]) -> np.ndarray:
    return _numbers([lang.encode() + b"\t" + w for w, lang in zip(words, langs)])


def _numbers(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _bit(numbers: np.ndarray) -> np.ndarray:
    """The bit of each phrase, given the numbers of its words (one phrase a row)."""
    mixed = np.zeros(len(numbers), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(numbers.shape[1]):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + numbers[:, j]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(20)).astype(np.int64) % BITMAP_BITS


def _phrase(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _absorbed(candidates: DataFrame, shortest: int) -> DataFrame:
    """lang, phrase, longer: the most places of a longer candidate that holds the phrase's words side by side."""
    spans = F.expr(
        f"flatten(transform(sequence({shortest}, words - 1), s -> transform(sequence(1, words - s + 1), p -> named_struct('p', p, 's', s))))"
    )
    inner = candidates.where(F.col("words") > shortest).select("lang", "places", "_w", F.explode(spans).alias("x"))
    return inner.groupBy("lang", _phrase(F.col("_w"), F.col("x.p"), F.col("x.s")).alias("phrase")).agg(F.max("places").alias("longer"))


def _scored(candidates: DataFrame, grams: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score by the lowest cut. Parts are looked up by joins whose large keys Spark splits."""
    cuts = candidates.select("lang", "phrase", F.col("places").alias("a"), "_w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _phrase(F.col("_w"), F.lit(1), F.col("k")).alias("first"),
        _phrase(F.col("_w"), F.col("k") + 1, F.size("_w") - F.col("k")).alias("rest"),
    )
    part = lambda name, n: grams.select("lang", F.col("phrase").alias(name), F.col("places").alias(n))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr("(1000000BD * (cast(a AS decimal(16,0)) * cast(a AS decimal(16,0)))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    return lowest.select("lang", "phrase", "a", "c.l", "c.r", "c.score")


def _shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words, langs, text in _shards(batches):
        names = list(dict.fromkeys(langs))
        number = {x: i for i, x in enumerate(names)}
        lists = ((words, pa.binary()), ([number[x] for x in langs], pa.int32()), (names, pa.string()))
        columns = [pa.array([x], pa.list_(kind)) for x, kind in lists]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([text.astype(np.int32).tobytes()], pa.binary())], ["words", "langs", "names", "text"])


def _counting(bitmaps, size: int, longest: int):
    """Counts of the phrases of one size whose parts of one word less may be frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words, langs, names, text = (batch.column(i)[row] for i in range(4))
                yield from _counted(
                    words.values.cast(pa.binary()), langs.values.to_numpy(), names.as_py(), np.frombuffer(text.as_py(), np.int32), bitmaps.value, size, longest
                )

    return count


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[str], np.ndarray]]:
    """(word of each number, its language, the words as numbers with 0 between pieces) of about SHARD_WORDS words."""
    numbers: dict[str, defaultdict[bytes, int]] = {}
    fresh = itertools.count(2)  # 0 ends a piece, 1 is nothing: what lies between two blanks
    parts, held = [], 0

    def whole(text: np.ndarray) -> tuple[list[bytes], list[str], np.ndarray]:
        known = sorted((n, w, lang) for lang, d in numbers.items() for w, n in d.items() if n > 1)
        place = np.zeros(max((n for n, _, _ in known), default=1) + 1, np.int64)
        place[[n for n, _, _ in known]] = np.arange(1, len(known) + 1)
        return [w for _, w, _ in known], [lang for _, _, lang in known], place[text]

    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            by_lang = defaultdict(list)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary())):
                by_lang[lang].append(text.as_py() or b"")
            for lang, texts in by_lang.items():
                if lang not in numbers:
                    numbers[lang] = defaultdict(fresh.__next__, {b"": 1, b"\n": 0})
                for piece in _pieces(b"\n".join([b"", *texts, b""])):
                    words = piece.translate(WORD_BYTES).replace(b"\n", b" \n ").split(b" ")
                    ids = np.fromiter(map(numbers[lang].__getitem__, words), np.int32, len(words))
                    parts.append(ids[ids != 1])
                    held += len(parts[-1])
                if held >= SHARD_WORDS:
                    yield whole(np.concatenate(parts))
                    numbers, fresh, parts, held = {}, itertools.count(2), [], 0
                    numbers[lang] = defaultdict(fresh.__next__, {b"": 1, b"\n": 0})
    if held:
        yield whole(np.concatenate(parts))


def _pieces(text: bytes) -> Iterator[bytes]:
    """text in parts of about PIECE_BYTES that end at a blank."""
    start = 0
    while start < len(text):
        end = start + PIECE_BYTES
        if end < len(text):
            end = text.find(b" ", end)
            end = len(text) if end < 0 else end
        yield text[start:end]
        start = end


def _counted(words: pa.Array, langs: np.ndarray, names: list[str], text: np.ndarray, bitmaps: list[np.ndarray], size: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Rows of COUNTS: the phrases of `size` words; with the single words also the number of words of each language."""
    index = BidirectionalIndex(text, len(words), longest)
    codes = pa.DictionaryArray.from_arrays(pa.array(langs), pa.array(names, pa.string())).cast(pa.string())
    keys = pc.binary_join_element_wise(codes.cast(pa.binary()), words, b"\t")
    single, held = index.single_words()
    if size == 1:
        total = np.bincount(langs[single[:, 0] - 1], weights=held.size, minlength=len(names))
        yield _rows(pa.array([f"{x}\t".encode() for x in names], pa.binary()), total.astype(np.int64))
    else:
        numbers = np.concatenate((np.zeros(1, np.uint64), _numbers(keys.to_pylist())))
    # A phrase's extensions come from its own interval, so slices of the first words are extended one after the other, and only the index grows with a shard.
    slices = (np.cumsum(held.size) - held.size) // SLICE_PLACES
    for here in np.split(np.arange(len(single)), np.flatnonzero(np.diff(slices)) + 1):
        phrases, places = _kept(single, held, here)
        for reached in range(1, size):
            frequent = lambda some: _holds(bitmaps[reached - 1], _bit(numbers[some]))  # noqa: B023, E731
            phrases, places = _kept(phrases, places, frequent(phrases))
            # To the right first, then to the left: each needs the interval that the other direction has kept in step.
            phrases, places = index.extended(phrases, places, right=reached % 2 == 1, onward=reached + 1 < size)
            phrases, places = _kept(phrases, places, frequent(phrases[:, 1:] if reached % 2 == 1 else phrases[:, :-1]))
        for at in range(0, len(phrases), 1 << 16):
            ids = phrases[at : at + (1 << 16)] - 1
            yield _rows(pc.binary_join_element_wise(keys.take(pa.array(ids[:, 0])), *(words.take(pa.array(ids[:, j])) for j in range(1, size)), b" "), places.size[at : at + (1 << 16)])


def _holds(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 5] >> (at & 31).astype(np.uint32)) & 1 > 0


def _kept(phrases: np.ndarray, places: "Places", keep: np.ndarray) -> tuple[np.ndarray, "Places"]:
    return phrases[keep], Places(places.forward[keep], places.backward[keep], places.size[keep])


def _rows(keys: pa.Array, places: np.ndarray) -> pa.RecordBatch:
    # Not checked again: words are cut at ASCII characters only.
    return pa.RecordBatch.from_arrays([keys.view(pa.string()), pa.array(places, pa.int64())], ["key", "places"])


def _ranked(numbers: np.ndarray) -> np.ndarray:
    """The order of numbers from 0, equal ones as they were: by 16 bits at a time, for which numpy has a counting sort."""
    order = np.argsort((numbers & 0xFFFF).astype(np.uint16), kind="stable").astype(np.int32)
    for shift in range(16, int(numbers.max(initial=0)).bit_length(), 16):
        order = order[np.argsort(((numbers >> shift) & 0xFFFF).astype(np.uint16)[order], kind="stable")]
    return order


class Places:
    """Intervals of phrases: where they begin in the order of suffixes and in that of reversed prefixes, and how wide they are in both."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, size: np.ndarray):
        self.forward, self.backward, self.size = forward, backward, size


class BidirectionalIndex:
    """An FM-index of a text of numbers 1 to `words`, 0 between pieces, for phrases of up to `depth` words, read in both directions."""

    def __init__(self, text: np.ndarray, words: int, depth: int):
        self.text, self.words = np.concatenate(([0], text, [0])).astype(np.int32), words
        self.first = np.concatenate(([0], np.cumsum(np.bincount(self.text, minlength=words + 1))))
        self.depth, self._made = depth, {}

    def _side(self, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """The transform of one direction, made when first needed."""
        if right not in self._made:
            self._made[right] = self._transform(self.text[::-1] if right else self.text, self.depth)
        return self._made[right]

    @staticmethod
    def _transform(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The word before each suffix in suffix order, and the sorted keys (word, place in that order) that answer rank queries."""
        order = np.arange(len(text), dtype=np.int32)
        for _ in range(depth - 1):  # backward steps: suffixes sorted by one more word each time, equal ones as they were
            before = np.where(order > 0, order, len(text)).astype(np.int32) - np.int32(1)
            order = before[_ranked(text[before])]
        transform = text[order - 1]
        keys = transform.astype(np.int64) * len(text)
        keys += np.arange(len(text))
        keys.sort()
        return transform, keys

    def single_words(self) -> tuple[np.ndarray, Places]:
        """Every word as a phrase (one row of numbers each) and its places."""
        word = np.arange(1, self.words + 1)
        size = np.diff(self.first)[1:]
        word, size = word[size > 0], size[size > 0]
        return word[:, None], Places(self.first[word], self.first[word], size)

    def extended(self, phrases: np.ndarray, places: Places, right: bool, onward: bool = True) -> tuple[np.ndarray, Places]:
        """All phrases that begin (right) or end with one of these and have one word more, with their places; of places that are not extended onward, the numbers only."""
        transform, keys = self._side(right)
        begin = places.backward if right else places.forward
        ends = np.cumsum(places.size)
        owner = np.repeat(np.arange(len(begin)), places.size)
        symbol = transform[np.repeat(begin - (ends - places.size), places.size) + np.arange(len(owner))]
        # Runs of equal (phrase, word): the extensions with their numbers of places; 0 sorts first in a phrase, so it counts as smaller.
        both, size = np.unique(owner * (self.words + 1) + symbol, return_counts=True)
        parent, word = both // (self.words + 1), both % (self.words + 1)
        before = np.cumsum(size) - size
        new = np.ones(len(parent), bool)
        new[1:] = parent[1:] != parent[:-1]
        smaller = before - np.maximum.accumulate(np.where(new, before, 0))
        keep = word > 0
        parent, word, size, smaller = (x[keep] for x in (parent, word, size, smaller))
        longer = np.column_stack((phrases[parent], word) if right else (word, phrases[parent]))
        if not onward:
            return longer, Places(size, size, size)
        stepped = np.searchsorted(keys, word * len(self.text) + begin[parent])
        other = (places.forward if right else places.backward)[parent] + smaller
        return longer, Places(other, stepped, size) if right else Places(stepped, other, size)


#: DuckDB twin of the registered query.
PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), lists AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[ \t]+') IF x <> ''] AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, s, count(*) AS f FROM places, (SELECT unnest([1, 2, 3]) AS s) WHERE i + s - 1 <= len(w) GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE s = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, s, f, string_split(phrase, ' ') AS w FROM grams WHERE s > 1 AND f >= 10),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM candidates WHERE s = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM candidates WHERE s = 3
  ) GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer g ON c.s = 2 AND c.lang = g.lang AND c.phrase = g.phrase WHERE g.f IS NULL OR 100 * g.f < 50 * c.f
), cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM kept, (SELECT unnest([1, 2]) AS k) WHERE k < s
), scored AS (
  SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score, k
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.x JOIN grams y ON y.lang = c.lang AND y.phrase = c.y
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, a, l, r, score FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
