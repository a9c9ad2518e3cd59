"""Ranked lexical search, collocations and languages against SQL, brute force and held-out labels."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorwatch.llm import languages, lexical_search, phrases
from sensorwatch.llm.catalog import QUERIES, SQL

SAMPLE = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns that the operators name themselves, carried by the tables to no effect.
CLASHES = {"rank": 5, "score": 7, "terms": "x", "n_terms": 3, "counts": "y", "phrase": "p", "places": 9, "words": 2, "_key": 4, "_cut": 6, "a": 1, "n": 8}


def rows_of(spark, rows, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    extra = {k: v for k, v in CLASHES.items() if k not in names}
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) else 'int'}" for k, v in extra.items())
    return spark.createDataFrame([(*r, *extra.values()) for r in rows], f"{schema}, {kinds}")


@pytest.mark.parametrize("name", ["op11_document_fp_tree", "op12_fm_index_collocations"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SAMPLE}/{t}.parquet'")
    found = QUERIES[name](spark, SAMPLE)
    wanted = con.execute(SQL[name])
    assert [d[0] for d in wanted.description] == found.columns
    wanted, found = wanted.fetchall(), [tuple(r) for r in found.collect()]
    assert len(found) > 100 and sorted(found) == sorted(wanted)


# ---- ranked lexical search


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_search(docs, items, k=10):
    """The contract, word for word."""
    held = [(d, Counter(terms_of(t))) for d, t in docs if terms_of(t)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item].update(terms_of(text))
    out = []
    for item, terms in wanted.items():
        ranked = []
        for place, (doc, c) in enumerate(held):
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                ranked.append((-score, doc is None, doc or 0, place))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc, _) in enumerate(sorted(ranked)[:k], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, k=10):
    found = lexical_search.top_documents(rows_of(spark, docs, "doc_id long, text string"), rows_of(spark, items, "item_id long, text string"), k)
    return sorted((tuple(r) for r in found.collect()), key=str)


def random_docs(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "ÄB", "x1"]
    text = lambda: " ".join(rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(len(vocabulary))], k=rng.randint(0, 60)))
    return [(i, text()) for i in range(n)]


def test_search_equals_brute_force(spark, monkeypatch):
    """Many shards, leaves, blocks of items and scans."""
    docs = random_docs(1, 900)
    docs += [(1000 + i, docs[3][1]) for i in range(150)]  # copies: equal scores
    items = [(i, t) for i, t in random_docs(2, 25)]
    wanted = brute_search(docs, items)
    for leaf, shard, block, scan in ((64, 16_384, 8_192, 1 << 18), (3, 100, 10, 25)):
        for name, value in (("LEAF_DOCS", leaf), ("SHARD_DOCS", shard), ("BLOCK_TERMS", block), ("PASS_TERMS", scan)):
            monkeypatch.setattr(lexical_search, name, value)
        assert searched(spark, docs, items) == wanted


def test_search_of_odd_input(spark):
    docs = [(1, "Wort 'Été' a-b"), (2, None), (3, ""), (4, "... !"), (None, "wort wort"), (5, "WORT"), (5, "WORT"), (6, "wort " * 3000 + "selten"), (7, "a\0b\tc")]
    docs += [(100 + i, "anders hier") for i in range(20)]
    items = [(1, "wort!"), (2, None), (3, "..."), (None, "selten"), (4, "b été"), (4, "c"), (4, "c")]
    found = searched(spark, docs, items)
    assert found == brute_search(docs, items)
    assert [(r[1], r[2]) for r in sorted(x for x in found if x[0] == 1)] == [(1, 6), (2, None), (3, 5), (4, 5), (5, 1)]
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == [] and searched(spark, docs, [(1, None)]) == []
    assert searched(spark, [(1, None)], items) == []


def test_branch_and_bound_skips_and_bounds_hold(monkeypatch):
    """Bounds are never below a score, and far fewer documents are scored than there are."""
    monkeypatch.setattr(lexical_search, "LEAF_DOCS", 4)
    rng = np.random.default_rng(3)
    n, width = 3000, 60
    lists = [np.unique(rng.zipf(1.3, rng.integers(1, 30)) % width) for _ in range(n)]
    sizes = np.array([len(x) for x in lists])
    places = np.concatenate(lists).astype(np.int32)
    counts = rng.integers(1, 4, len(places)).astype(np.int32)
    norm = rng.integers(10, 400, n)
    tree = lexical_search.DocumentTree(np.arange(n), norm, sizes, places, counts, width)
    weights = np.array([900, 4000, 7000], np.int64)
    wanted = np.array([3, 20, 41])
    owner = np.repeat(np.arange(n), sizes)
    impact = 10**9 * counts.astype(np.int64) // (1000 * counts + 8 * norm[owner])
    scores = np.zeros(n, np.int64)
    for p, w in zip(wanted, weights):
        np.add.at(scores, owner[places == p], w * impact[places == p])
    best = np.lexsort((np.arange(n), -scores))[:10]
    found = tree.best(wanted, weights, 10, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    assert found[0].tolist() == scores[best].tolist() and found[1].tolist() == best.tolist()
    bounds = (tree.bound[:, wanted] * weights).sum(axis=1)
    opened = 0
    for node, leaf in enumerate(tree.leaves):
        if leaf:
            held = scores[tree.ids[leaf[0] : leaf[1]]]
            assert bounds[node] >= held.max()
            opened += len(held) if bounds[node] >= found[0][-1] else 0
    assert opened < n / 2


def test_terms_of_pieces(monkeypatch):
    monkeypatch.setattr(lexical_search, "PIECE_BYTES", 7)
    for text in ("", "abc", "Ein sehr-langerundungeteilter Text, 12 Wörter " * 3, "x" * 50, "a " * 20, " ! " * 9):
        found = [t.decode() for p in lexical_search.term_pieces(text.encode()) for t in p]
        assert found == terms_of(text)


# ---- collocations


def brute_phrases(docs, least=10, top=2000, longest=3):
    counts, total = Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for s in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + s])) for i in range(len(words) - s + 1))
    candidates = {x: a for x, a in counts.items() if len(x[1]) > 1 and a >= least}
    best = defaultdict(list)
    for (lang, w), a in candidates.items():
        inside = any(
            len(v) > len(w) and 100 * b >= 50 * a and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
            for (other, v), b in candidates.items() if other == lang
        )
        if not inside:
            cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            best[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, r, p.decode(), -a, left, right, total[lang], -s)
        for lang, rows in best.items() for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def mined(spark, docs, **options):
    return sorted(tuple(r) for r in phrases.collocations(rows_of(spark, docs, "text string, lang string"), **options).collect())


def random_texts(seed, n):
    rng = random.Random(seed)
    word = lambda: rng.choice(["A", "b", "été", "É", "d\x0b", "e.", "f\t", "\x1c", "ab-c"])
    return [("  ".join(word() for _ in range(rng.randint(0, 30))), rng.choice(["x", "y", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("shard", [1 << 21, 50])
def test_phrases_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    docs = random_texts(1, 150) + [("stets gleich hier " * 40, "x")] * 3 + [(None, "x"), ("", None), (" \t", "z")]
    assert mined(spark, docs) == brute_phrases(docs)
    assert mined(spark, docs, least=4, top=7, longest=4) == brute_phrases(docs, 4, 7, 4)
    assert mined(spark, []) == []


def test_products_beyond_64_bits(spark):
    """1000000 a a and l r pass 64 bits; the cut's score is still exact."""
    a, left, right = 4_000_000_000_000, 4_000_000_000_001, 4_000_000_000_007
    grams = spark.createDataFrame([("x", "p q", 2, a), ("x", "p", 1, left), ("x", "q", 1, right)], "lang string, phrase string, words int, places long")
    from pyspark.sql import functions as F

    row = phrases._scored(grams.where("words = 2").withColumn("_w", F.split("phrase", " ")), grams).first()
    assert row.score == 10**6 * a * a // (left * right)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60), st.integers(1, 4))
def test_index_counts_every_phrase(text, longest):
    """Intervals of both directions, extended to either side in turn, are as wide as the phrases are frequent."""
    used = sorted({x for x in text if x})
    numbers = np.array([0 if not x else used.index(x) + 1 for x in text], np.int64)
    index = phrases.BidirectionalIndex(numbers, len(used), longest)
    found, places = index.single_words()
    for size in range(1, longest + 1):
        wanted = Counter(tuple(numbers[i : i + size]) for i in range(len(numbers) - size + 1) if all(numbers[i : i + size]))
        assert {tuple(p): n for p, n in zip(found.tolist(), places.size.tolist())} == wanted
        if size < longest:
            found, places = index.extended(found, places, right=size % 2 == 1)


def test_a_shard_is_extended_in_slices(monkeypatch):
    """Beside its index, counting a shard holds the places of a slice of it, and returns the same rows."""
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[k] for k in rng.integers(0, 400, 500)) for _ in range(8)]
    shard = next(phrases._shards(iter([pa.RecordBatch.from_pydict({"lang": ["x"] * 8, "text": texts})])))
    held, extended = [], phrases.BidirectionalIndex.extended
    monkeypatch.setattr(phrases, "SLICE_PLACES", 100, raising=False)
    monkeypatch.setattr(phrases.BidirectionalIndex, "extended", lambda self, some, places, *a, **k: held.append(int(places.size.sum())) or extended(self, some, places, *a, **k))
    every = np.full(phrases.BITMAP_BITS >> 5, 0xFFFFFFFF, np.uint32)
    names, langs = pa.array(shard[0], pa.binary()), np.zeros(len(shard[0]), np.int32)
    for size in (2, 3):
        found = Counter()
        for batch in phrases._counted(names, langs, ["x"], shard[2], [every] * (size - 1), size, 3):
            found.update(dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
        split = [t.split(" ") for t in texts]
        assert found == Counter(f"x\t{' '.join(w[i : i + size])}" for w in split for i in range(len(w) - size + 1))
    assert max(held) <= 100 + max(Counter(w for t in texts for w in t.split(" ")).values())


def test_a_row_group_holds_one_shard(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_WORDS", 50)
    read, staged = [], phrases.staged
    monkeypatch.setattr(phrases, "staged", lambda df, name, **options: read.append((name, staged(df, name, **options))) or read[-1][1])
    mined(spark, random_texts(2, 150))
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in next(df for name, df in read if name == "shards").inputFiles()]
    rows = [m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)]
    assert len(rows) > 10 and set(rows) == {1}


# ---- languages


def chain_marginals(model, evidence):
    """All labelings, one by one."""
    n, langs = evidence.shape
    out, whole = np.zeros((n, langs)), 0.0
    for path in itertools.product(range(langs), repeat=n):
        weight = model.start[path[0]] + sum(evidence[i, y] for i, y in enumerate(path)) + sum(model.transition[a, b] for a, b in zip(path, path[1:]))
        for i, y in enumerate(path):
            out[i, y] += math.exp(weight)
        whole += math.exp(weight)
    return out / whole


def small_model(seed, langs=3):
    rng = np.random.default_rng(seed)
    none = np.zeros((languages.LEXICON_BUCKETS, langs), np.float32)
    return languages.LanguageModel(list("abcdefgh"[:langs]), np.zeros((languages.GRAM_BUCKETS + 1, langs), np.float32), none, rng.normal(size=(langs, langs)), rng.normal(size=langs))


@pytest.mark.parametrize("block", [1, 2, 3, 32])
def test_forward_backward_equals_enumeration(monkeypatch, block):
    """Chains of all lengths together, cut into blocks of any size."""
    monkeypatch.setattr(languages, "BLOCK", block)
    model, rng = small_model(block), np.random.default_rng(5)
    lengths = np.array([1, 7, 2, 5, 6, 3, 1])
    evidence = rng.normal(size=(lengths.sum(), 3)) * 3
    found, at = languages.marginals(model, evidence, lengths), 0
    for n in lengths:
        assert np.allclose(found[at : at + n], chain_marginals(model, evidence[at : at + n]))
        at += n


def test_long_chains_do_not_vanish():
    model = small_model(1)
    found = languages.marginals(model, np.random.default_rng(2).normal(size=(50_000, 3)) * 40, np.array([49_990, 10]))
    assert np.isfinite(found).all() and np.allclose(found.sum(axis=1), 1)


def test_languages_of_held_out_documents(spark):
    found = QUERIES["op13_crf_languages"](spark, SAMPLE)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    joined = found.join(spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in joined if r.held_out]
    assert len(joined) == 200 and 40 < len(held) < 100
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in joined)


def test_spans_of_switched_text(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    model = languages.fit_languages(docs)
    texts = {r.lang: r.text for r in docs.where("length(text) > 400").orderBy("doc_id").collect()}
    parts = [(lang, languages.words_of(texts[lang])[5:35]) for lang in ("de", "en", "fr")]
    mixed = b" ".join(w for _, words in parts for w in words).decode()
    spans = languages.language_spans(rows_of(spark, [(1, mixed), (2, None), (3, "12 !")], "doc_id long, text string"), model).collect()
    labels = [s.lang for s in sorted(spans, key=lambda s: s.first) for _ in range(s.last - s.first + 1)]
    wanted = [lang for lang, words in parts for _ in words]
    assert {s.doc_id for s in spans} == {1} and len(labels) == len(wanted)
    assert sum(a == b for a, b in zip(labels, wanted)) >= 0.85 * len(wanted)


def test_languages_of_odd_input(spark):
    docs = [(1, "der die und das", "de"), (2, "the of and in", "en"), (3, None, "de"), (4, "", "en"), (5, "123 — ... ²", None), (5, "the and", None), (None, "of the the", "de")]
    frame = rows_of(spark, docs, "doc_id long, text string, lang string")
    model = languages.fit_languages(frame)
    assert model.langs == ["de", "en"]
    found = sorted((tuple(r) for r in languages.document_languages(frame, model).collect()), key=str)
    assert len(found) == len(docs)
    assert {(i, x) for i, x, s in found if s == 0} == {(3, "und"), (4, "und"), (5, "und")}
    assert {x for i, x, s in found if i == 1 or i == 2} <= {"de", "en"} and (5, "en") in {f[:2] for f in found}
    nothing = languages.fit_languages(frame.where("false"))
    assert nothing is None and {tuple(r)[1:] for r in languages.document_languages(frame, nothing).collect()} == {("und", 0.0)}
    assert languages.document_languages(frame.where("false"), model).count() == 0
    single = languages.fit_languages(frame.where("lang = 'de'"))
    assert {r.lang_pred for r in languages.document_languages(frame, single).collect()} == {"de", "und"}
    long = rows_of(spark, [(1, "der " * 200_000), (2, "the " * 3)], "doc_id long, text string")
    assert [r.lang_pred for r in languages.document_languages(long, model).orderBy("doc_id").collect()] == ["de", "en"]
