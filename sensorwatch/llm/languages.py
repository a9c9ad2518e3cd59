"""Language identification of code-switched text: a linear-chain conditional random field labels every word with a language.

Method: a word's evidence is a sum of learned weights of its byte n-grams of two to four (with marks at both ends, so that those at a mark are its
affixes) and of a weighted lexicon entry; learned transitions tie neighbouring words together. Forward-backward gives each word the probability of each
language. A document's language is the one with the largest sum over its words, its score that sum's share.

Words are runs of characters other than ASCII non-letters, lowered. Only words that hold a letter count towards a document.

Learning: the lexicon counts the words of all learning documents by language, in LEXICON_BUCKETS hashed entries (rare words may share an entry; none is
dropped). The weights are fitted on a bounded sample: of each language the DOCUMENTS_OF_A_LANGUAGE documents with the smallest hashes of their id,
of each up to SEGMENTS runs of SEGMENT_WORDS words spread over the whole text. Runs of all languages follow each other in the order of their hashes, so
that the sequences learned from are code-switched. A word's own occurrence is taken out of the lexicon while it is learned from. The driver
holds this sample and the tables only, (LEXICON_BUCKETS + GRAM_BUCKETS) numbers for each language.

Inference covers whole texts as one chain each. Chains are cut into blocks of BLOCK words whose transfer matrices are made side by side; a scan
over the blocks hands the messages on exactly, so a long text costs memory in proportion to itself only.

Odd input: a null text, an empty one and one without a letter is `und` with score 0. Documents with a null language or id are not learned from.
Without any learning document everything is `und` with score 0. Equal sums go to the language that sorts first. Repeated rows, and rows that share an id, are
labelled one by one. An empty table gives an empty result. Other columns, whatever their names, have no influence.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Executors need not have this package: the functions of this module travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNDETERMINED = "und"
LEXICON_BUCKETS, GRAM_BUCKETS = 1 << 17, 1 << 17
DOCUMENTS_OF_A_LANGUAGE, SEGMENTS, SEGMENT_WORDS, SEQUENCE_SEGMENTS = 1_000, 8, 8, 4
EPOCHS, BATCH, RATE, DECAY = 6, 128, 0.2, 1e-4
BLOCK = 32
#: Words labelled together, and words whose evidence a task remembers.
GROUP_WORDS, KNOWN_WORDS = 100_000, 300_000
#: ASCII letters and bytes of characters beyond ASCII stay, the rest parts words.
LETTER_BYTES = bytes(b if 97 <= b <= 122 or 65 <= b <= 90 or b >= 128 else 32 for b in range(256))
GRAM_SIZES = (2, 3, 4)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(LETTER_BYTES).split()


def gram_places(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the marked words the buckets of the n-grams that begin there (GRAM_BUCKETS where none does), and where each word begins."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    data = np.frombuffer(b"\x02" + b"\x03\x02".join(words) + b"\x03\0\0\0", np.uint8).astype(np.uint64)
    n = int(sizes.sum())
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - np.arange(n)
    places, rolled = np.empty((n, len(GRAM_SIZES)), np.int32), data[:n]
    with np.errstate(over="ignore"):
        for size in range(2, GRAM_SIZES[-1] + 1):
            rolled = rolled * np.uint64(0x100000001B3) + data[size - 1 : size - 1 + n] + np.uint64(size)
            mixed = (rolled * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(47)
            places[:, size - 2] = np.where(room >= size, mixed, GRAM_BUCKETS)
    return places, ends - sizes


def lexicon_places(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % LEXICON_BUCKETS


def log_shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Smoothed log frequency of a lexicon entry in each language against its mean over the languages."""
    share = np.log((counts + 0.5) / (totals + 0.5 * LEXICON_BUCKETS))
    return np.clip(share - share.mean(axis=1, keepdims=True), -6, 6)


@dataclass
class LanguageModel:
    """langs in sorted order; grams (GRAM_BUCKETS + 1, languages) with a last row of zeros; lexicon (LEXICON_BUCKETS, languages) already weighted."""

    langs: list[str]
    grams: np.ndarray
    lexicon: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    def evidence(self, words: list[bytes]) -> np.ndarray:
        """Log evidence (words, languages)."""
        places, begins = gram_places(words)
        return np.add.reduceat(self.grams[places].sum(axis=1, dtype=np.float64), begins) + self.lexicon[lexicon_places(words)]


# --- forward-backward ---------------------------------------------------------------------------------------------------------------------


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def messages(evidence: np.ndarray, held: np.ndarray, lead: np.ndarray, step: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages (blocks, BLOCK, languages). held: which places hold words; lead: what reaches the first word; after: what
    comes back from behind the block. Places without words repeat their neighbour's message."""
    n, width, _ = evidence.shape
    forward, backward = np.empty_like(evidence), np.empty_like(evidence)
    now = _normal(lead * evidence[:, 0])
    forward[:, 0] = now
    for k in range(1, width):
        now = np.where(held[:, k, None], _normal((now @ step) * evidence[:, k]), now)
        forward[:, k] = now
    now = backward[:, width - 1] = after
    for k in range(width - 1, 0, -1):
        now = np.where(held[:, k, None], _normal((now * evidence[:, k]) @ step.T), now)
        backward[:, k - 1] = now
    return forward, backward


def marginals(model: LanguageModel, evidence: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probability of each language for each word of documents with these numbers of words (all above 0)."""
    langs, blocks = evidence.shape[1], -(-lengths // BLOCK)
    order = np.argsort(-blocks, kind="stable")
    first = np.concatenate(([0], np.cumsum(blocks)))[:-1]
    total = int(blocks.sum())
    begin = np.cumsum(lengths) - lengths
    inside = np.arange(len(evidence)) - np.repeat(begin, lengths)
    row, slot = np.repeat(first, lengths) + inside // BLOCK, inside % BLOCK
    packed, held = np.ones((total, BLOCK, langs)), np.zeros((total, BLOCK), bool)
    packed[row, slot] = np.exp(np.maximum(evidence - evidence.max(axis=1, keepdims=True), -500))
    held[row, slot] = True
    step, begins = np.exp(model.transition), np.zeros(total, bool)
    begins[first] = True
    enter = np.where(begins[:, None, None], np.exp(model.start)[None, None, :], step[None])
    # What a block makes of any language before it: one matrix for each block, all blocks side by side.
    through = enter * packed[:, 0][:, None, :]
    through /= through.sum(axis=(1, 2), keepdims=True)
    for k in range(1, BLOCK):
        moved = (through @ step) * packed[:, k][:, None, :]
        through = np.where(held[:, k, None, None], moved / moved.sum(axis=(1, 2), keepdims=True), through)
    # The scan over the blocks of each document; documents with most blocks first, so that those still running are a prefix.
    before, after = np.empty((total, langs)), np.empty((total, langs))
    running = np.searchsorted(-blocks[order], -np.arange(1, blocks.max() + 1), side="right")
    now = np.full((len(order), langs), 1 / langs)
    for j, n in enumerate(running):
        at = first[order[:n]] + j
        before[at] = now[:n]
        now = _normal((now[:n, None, :] @ through[at])[:, 0])
    last = first + blocks - 1
    after[last] = 1 / langs
    for j in range(len(running) - 1, 0, -1):
        at = first[order[: running[j]]] + j
        after[at - 1] = _normal((through[at] @ after[at][:, :, None])[:, :, 0])
    lead = (before[:, None, :] @ enter)[:, 0]
    forward, backward = messages(packed, held, lead, step, after)
    return _normal(forward[row, slot] * backward[row, slot])


# --- learning -----------------------------------------------------------------------------------------------------------------------------


def fit_languages(docs: DataFrame) -> LanguageModel | None:
    """A model learned from doc_id, text and lang; None when no row has an id and a language."""
    docs = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where("doc_id IS NOT NULL AND lang IS NOT NULL")
    langs = sorted(r.lang for r in docs.groupBy("lang").count().collect())
    if not langs:
        return None
    counts = _lexicon(docs, langs)
    return _trained(langs, counts, _sample(docs))


def _lexicon(docs: DataFrame, langs: list[str]) -> np.ndarray:
    """(LEXICON_BUCKETS, languages) counts of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, table, number = {}, np.zeros((len(langs), LEXICON_BUCKETS), np.int64), {x: i for i, x in enumerate(langs)}
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch, by_lang = whole.slice(at, 256), {}
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = words_of(text)
                    if len(places) > KNOWN_WORDS:
                        places = {}
                    if new := {w for w in words if w not in places}:
                        places.update(zip(new, lexicon_places(list(new)).tolist()))
                    by_lang.setdefault(lang, []).append(np.fromiter(map(places.__getitem__, words), np.int64, len(words)))
                for lang, found in by_lang.items():
                    table[number[lang]] += np.bincount(np.concatenate(found), minlength=LEXICON_BUCKETS)
        lang, bucket = np.nonzero(table)
        for at in range(0, len(lang), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang[part], pa.int32()), pa.array(bucket[part], pa.int32()), pa.array(table[lang[part], bucket[part]])], ["lang", "bucket", "n"]
            )

    counted = docs.select("lang", "text").mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows, table = counted.toArrow(), np.zeros((LEXICON_BUCKETS, len(langs)), np.int64)
    table[rows["bucket"].to_numpy(), rows["lang"].to_numpy()] = rows["n"].to_numpy()
    return table


def _sample(docs: DataFrame) -> list[tuple[str, list[bytes]]]:
    """(language, words) of the runs to learn from, in the order of hashes."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id"))
    place = Window.partitionBy("lang").orderBy("_key")
    chosen = keyed.select("lang", "_key").withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= DOCUMENTS_OF_A_LANGUAGE)
    cuts = chosen.groupBy("lang").agg(F.max("_key").alias("_cut"))
    drawn = keyed.join(F.broadcast(cuts), "lang").where(F.col("_key") <= F.col("_cut")).select("lang", "_key", "text")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                starts = sorted({j * max(len(words) - SEGMENT_WORDS, 0) // (SEGMENTS - 1) // SEGMENT_WORDS * SEGMENT_WORDS for j in range(SEGMENTS)})
                out += [(lang, zlib.crc32(b"%d %d" % (key, s)), words[s : s + SEGMENT_WORDS]) for s in starts if words]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.list_(pa.binary())))], ["lang", "key", "words"])

    found = drawn.mapInArrow(runs, "lang string, key long, words array<binary>").toArrow().to_pylist()
    return [(r["lang"], r["words"]) for r in sorted(found, key=lambda r: (r["key"], r["lang"], r["words"]))]


def _trained(langs: list[str], counts: np.ndarray, sample: list[tuple[str, list[bytes]]]) -> LanguageModel:
    """Maximum likelihood of the word labels by adaptive gradient steps; the same result for the same sample."""
    n_langs, totals = len(langs), counts.sum(axis=0)
    width = SEGMENT_WORDS * SEQUENCE_SEGMENTS
    names = list(dict.fromkeys(w for _, words in sample for w in words))
    number, lang_number = {w: i for i, w in enumerate(names)}, {x: i for i, x in enumerate(langs)}
    rows = -(-len(sample) // SEQUENCE_SEGMENTS)
    word, label, held = np.zeros((rows, width), np.int64), np.zeros((rows, width), np.int64), np.zeros((rows, width), bool)
    for i in range(rows):
        line = [(number[w], lang_number[lang]) for lang, words in sample[i * SEQUENCE_SEGMENTS : (i + 1) * SEQUENCE_SEGMENTS] for w in words]
        word[i, : len(line)], label[i, : len(line)] = zip(*line)
        held[i, : len(line)] = True
    grams, transition, start, trust = np.zeros((GRAM_BUCKETS + 1, n_langs)), np.zeros((n_langs, n_langs)), np.zeros(n_langs), np.array([0.5])
    lexicon = log_shares(counts, totals) if sample else np.zeros((LEXICON_BUCKETS, n_langs))
    if not sample or n_langs == 1:
        return LanguageModel(langs, grams.astype(np.float32), (trust * lexicon).astype(np.float32), transition, start)
    places, begins = gram_places(names)
    bounds = np.append(begins, len(places))
    bucket = lexicon_places(names)
    seen = {id(x): np.full_like(x, 1e-8) for x in (grams, transition, start, trust)}

    def climb(x: np.ndarray, slope: np.ndarray, rows=slice(None)) -> None:
        seen[id(x)][rows] += slope**2
        x[rows] += RATE * slope / np.sqrt(seen[id(x)][rows])

    shuffled = np.random.default_rng(0)
    for _ in range(EPOCHS):
        order = shuffled.permutation(rows)
        for at in range(0, rows, BATCH):
            pick = order[at : at + BATCH]
            here, truth, mask = word[pick], label[pick], held[pick]
            used, back = np.unique(here, return_inverse=True)
            back = back.reshape(here.shape)
            spans = bounds[used + 1] - bounds[used]
            rows_of = np.repeat(bounds[used] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
            local = places[rows_of]
            sums = np.add.reduceat(grams[local].sum(axis=1), np.cumsum(spans) - spans)
            own = counts[bucket[here]].astype(float)
            np.put_along_axis(own, truth[:, :, None], np.maximum(np.take_along_axis(own, truth[:, :, None], 2) - 1, 0), 2)
            entry = log_shares(own.reshape(-1, n_langs), totals).reshape(own.shape)
            log = sums[back] + trust * entry
            evidence = np.exp(np.maximum(log - log.max(axis=2, keepdims=True), -500))
            step, lead = np.exp(transition), np.broadcast_to(np.exp(start), (len(pick), n_langs))
            forward, backward = messages(evidence, mask, lead, step, np.full((len(pick), n_langs), 1 / n_langs))
            believed = _normal(forward * backward)
            error = (np.eye(n_langs)[truth] - believed) * mask[:, :, None]
            pair = forward[:, :-1, :, None] * step * (evidence * backward)[:, 1:, None, :]
            pair = pair / pair.sum(axis=(2, 3), keepdims=True) * mask[:, 1:, None, None]
            moved = np.zeros((n_langs, n_langs))
            np.add.at(moved, (truth[:, :-1][mask[:, 1:]], truth[:, 1:][mask[:, 1:]]), 1)
            by_word = np.zeros((len(used), n_langs))
            np.add.at(by_word, back.ravel(), error.reshape(-1, n_langs))
            flat, each = local.ravel(), np.repeat(np.repeat(by_word, spans, axis=0), local.shape[1], axis=0)
            touched, at_row = np.unique(flat, return_inverse=True)
            slope = np.column_stack([np.bincount(at_row, weights=each[:, y], minlength=len(touched)) for y in range(n_langs)])
            slope -= DECAY * len(pick) * grams[touched]
            climb(grams, slope, touched)
            grams[GRAM_BUCKETS] = 0
            climb(transition, moved - pair.sum(axis=(0, 1)))
            climb(start, error[:, 0].sum(axis=0))
            climb(trust, np.array([(error * entry).sum()]))
    return LanguageModel(langs, grams.astype(np.float32), (trust * lexicon).astype(np.float32), transition, start)


# --- labelling ----------------------------------------------------------------------------------------------------------------------------


class Labeller:
    """Labels groups of texts; remembers the evidence of the words it has seen, up to KNOWN_WORDS."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.evidence, self.letters = np.zeros((0, len(self.model.langs))), np.zeros(0, bool)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if len(self.number) + len(new) > KNOWN_WORDS and self.number:
            self._forget()
            new = list(dict.fromkeys(words))
        if new:
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.evidence = np.concatenate((self.evidence, self.model.evidence(new)))
            self.letters = np.concatenate((self.letters, [w.isalpha() or any(c.isalpha() for c in w.decode("utf-8", "replace")) for w in new]))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def label(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of words, probability of each language for each word, whether the word holds a letter) of texts given as words."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ids = self._numbers([w for words in texts for w in words])
        full = lengths[lengths > 0]
        if not len(full):
            return lengths, np.zeros((0, len(self.model.langs))), np.zeros(0, bool)
        return lengths, marginals(self.model, self.evidence[ids], full), self.letters[ids]


def _groups(texts: list[str | None]) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in groups of about GROUP_WORDS words."""
    group, held = [], 0
    for text in texts:
        group.append(words_of(text))
        held += len(group[-1])
        if held >= GROUP_WORDS:
            yield group
            group, held = [], 0
    if group:
        yield group


def document_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred, score of every row of docs (doc_id, text)."""
    if model is None:
        return docs.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labeller = Labeller(model)
        for batch in batches:
            names, scores = [], []
            for group in _groups(batch.column(1).to_pylist()):
                lengths, chances, letters = labeller.label(group)
                owner = np.repeat(np.arange(len(group)), lengths)[letters]
                sums = np.column_stack([np.bincount(owner, weights=chances[letters, y], minlength=len(group)) for y in range(len(model.langs))])
                words = sums.sum(axis=1)
                best = sums.argmax(axis=1)
                names += [model.langs[b] if n else UNDETERMINED for b, n in zip(best.tolist(), words.tolist())]
                scores += np.where(words > 0, sums.max(axis=1) / np.maximum(words, 1e-300), 0.0).clip(0, 1).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(label, f"doc_id {id_type}, lang_pred string, score double")


def language_spans(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, first, last, lang, score: the stretches of words of one language in every text, by word number from 0; score is the mean probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labeller = Labeller(model)
        for batch in batches:
            ids, at, out = batch.column(0), 0, []
            for group in _groups(batch.column(1).to_pylist()):
                lengths, chances, _ = labeller.label(group)
                begin = 0
                for n in lengths.tolist():
                    here = chances[begin : begin + n]
                    best = here.argmax(axis=1)
                    edges = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), n] if n else []
                    out += [(at, a, b - 1, model.langs[best[a]], float(here[a:b, best[a]].mean())) for a, b in zip(edges, edges[1:])]
                    at, begin = at + 1, begin + n
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(columns[0], pa.int64())), *(pa.array(c, t) for c, t in zip(columns[1:], kinds))], ["doc_id", "first", "last", "lang", "score"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(spans, f"doc_id {id_type}, first int, last int, lang string, score double")
