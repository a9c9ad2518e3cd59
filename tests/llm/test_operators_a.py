"""Near-duplicates, line dedup, packing and toxicity against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorwatch.llm import packing, toxicity
from sensorwatch.llm.catalog import QUERIES, SQL
from sensorwatch.llm.common import components, gram_hashes, word_hashes, word_list
from sensorwatch.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines
from sensorwatch.llm.near_dedup import _signature, least_matches, near_duplicates

SAMPLE = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, key string, id string, cls string, bucket int"


def rows_of(spark, texts, schema=DOCS):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "k", "x", "y", 1) for i, t in texts], schema)


def words(n, tag="w"):
    return " ".join(f"{tag}{k}" for k in range(n))


# ---- components


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 12)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 200), (200, 300)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[k] for k in range(1, 13)} == {1} and {found[k] for k in range(100, 140)} == {100}
    assert found[200] == found[300] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- near-duplicates


def brute_components(texts):
    def shingles(text):
        w = word_list(text)
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in texts}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    held = defaultdict(list)
    for i, s in sets.items():
        both = Counter(j for g in s for j in held[g])
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                group[b] = a
        for g in s:
            held[g].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_near_duplicates_equal_brute_force(spark):
    table = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in table.collect()]
    base = words(300, "v").split()
    for k in range(60):  # a chain: each differs from the next by few words, the ends by many
        texts.append((5000 + k, " ".join(base[:k] + [f"x{k}"] + base[k + 1 :])))
    wanted = brute_components(texts)
    got = near_duplicates(rows_of(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == wanted
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_defined_cases(spark):
    long = words(40)
    texts = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b\n"), (6, "a b c"), (None, long), (7, long), (8, long.upper()), (8, long.upper()), (9, words(20_000, "z")), (10, words(20_000, "z"))]
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(rows_of(spark, texts)).collect() if r["doc_id"])
    assert got == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 36, 7, True), (8, 36, 7, False),
        (8, 36, 7, False), (9, 19_996, 9, True), (10, 19_996, 9, False),
    ]
    lone = [r for r in near_duplicates(rows_of(spark, texts)).collect() if r["doc_id"] is None]
    assert [(r["component_id"], r["kept"]) for r in lone] == [(None, True)]
    assert near_duplicates(rows_of(spark, [])).count() == 0


def test_signatures_estimate_similarity():
    a, b = words(400), " ".join(words(400).split()[40:] + words(40, "u").split())
    one, two = (gram_hashes(word_hashes(word_list(t)), 5) for t in (a, b))
    exact = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
    signs = [np.frombuffer(_signature(x), "<u2") for x in (one, two)]
    assert abs((signs[0] == signs[1]).mean() - exact) < 0.1
    least = least_matches()
    assert list(least) == sorted(least) and 0 < least[0] < 24 and least[-1] < 192


# ---- lines


def test_line_dedup_equals_sql(spark):
    got = sorted(tuple(r) for r in QUERIES["op10_cuckoo_line_dedup"](spark, SAMPLE).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SAMPLE}/documents.parquet'")
    assert got == sorted(con.execute(SQL["op10_cuckoo_line_dedup"]).fetchall())
    assert sum(r[2] for r in got) > 0


LINE = "This line is certainly longer than forty characters, yes"


def test_line_dedup_defined_cases(spark, folder):
    texts = [(k, f"\t{LINE.upper()} \nown {k}\n") for k in range(1, 6)] + [(6, None), (7, ""), (None, LINE), (8, "short\nshort"), (5, LINE)]
    got = sorted((r["doc_id"] or 0, r["n_lines"], r["n_dropped"], r["text"]) for r in dedup_lines(rows_of(spark, texts), folder).collect())
    assert got == [
        (0, 1, 0, LINE), *((k, 3, 1, f"own {k}\n") for k in range(1, 5)), (5, 1, 0, LINE), (5, 3, 0, f"\t{LINE.upper()} \nown 5\n"), (6, 1, 0, ""), (7, 1, 0, ""),
        (8, 2, 0, "short\nshort"),
    ]
    assert dedup_lines(rows_of(spark, []), folder + "/none").count() == 0


def test_deletions_bring_lines_back(spark, folder):
    docs = rows_of(spark, [(k, f"{LINE}\n{k}") for k in range(1, 7)])
    index = LineIndex(spark, folder)
    assert index.commit("a", docs.where("doc_id <= 4")) and not index.commit("a", docs)
    dropped = lambda rows: {r["doc_id"] for r in index.clean(rows).collect() if r["n_dropped"]}
    assert dropped(docs) == set()
    index.commit("b", docs.where("doc_id > 4"))
    assert dropped(docs) == {1, 2, 3, 4, 5}
    index.commit("c", deleted=docs.where("doc_id = 6"))
    assert dropped(docs.where("doc_id < 6")) == {1, 2, 3, 4}
    index.commit("d", deleted=docs.where("doc_id = 1"))
    assert dropped(docs.where("doc_id between 2 and 5")) == set()
    assert index.counts().where("n > 0").select("n", "keeper").collect()[0] == (4, 5)


def test_filters_that_ran_full_are_built_anew(spark, tmp_path):
    index = LineIndex(spark, f"{tmp_path}/grown", min_docs=2, shards=2)
    batch = lambda first, last: [(2 * k + c, f"a line of its own, number {k}, which two documents hold") for k in range(first, last) for c in (0, 1)]
    for name, rows in (("a", batch(0, 20)), ("b", batch(20, 600)), ("c", batch(600, 620))):
        index.commit(name, rows_of(spark, rows))
    kept = spark.read.parquet(f"{index.path}/filters").collect()
    assert len({(r["shard"], r["version"]) for r in kept}) == len(kept) and all(len(r["data"]) for r in kept)
    assert {r["doc_id"] for r in index.clean(rows_of(spark, batch(0, 620))).collect() if r["n_dropped"]} == {2 * k for k in range(620)}


def test_cuckoo_filter_keeps_what_it_holds():
    keys = np.random.default_rng(1).integers(0, 1 << 62, 20_000).astype(np.uint64)
    held = CuckooFilter.sized(len(keys))
    assert held.insert(keys) and held.contains(keys).all()
    held = CuckooFilter.read(held.bytes())
    held.delete(keys[:10_000])
    assert held.contains(keys[10_000:]).all() and held.contains(keys[:10_000]).mean() < 0.01


# ---- packing


def reference_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_file("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab é1'.\n\t  \x1c　sß"), max_size=40))
def test_encoder_equals_the_tokenizer(text):
    ids = packing.encoder(packing.tokenizer_file()).encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == reference_tokenizer().encode(text, add_special_tokens=False).ids


def test_packing_is_a_round_trip(spark):
    table = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    rows = QUERIES["op9_best_fit_packing"](spark, SAMPLE).collect()
    tokenizer, pieces, total = reference_tokenizer(), defaultdict(list), 0
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for doc in table.collect():
        ids = tokenizer.encode(doc["text"], add_special_tokens=False).ids + [0]
        start = 0
        for k, r in enumerate(sorted(pieces.pop(doc["doc_id"]), key=lambda r: r["piece"])):
            part = ids[start : start + r["length"]]
            assert (r["piece"], r["start"]) == (k, start) and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
            assert r["length"] == 2048 or k == 0
            start += r["length"]
        assert start == len(ids)
        total += start
    assert not pieces
    check_sequences(rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * total / 2048 + 1


def check_sequences(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


def test_packing_defined_cases(spark):
    texts = [(1, None), (2, ""), (None, "a"), (3, "b " * 5000), (3, "b " * 5000)]
    rows = packing.pack(rows_of(spark, texts)).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["length"]) for r in rows)[:3] == [(0, 0, 2), (1, 0, 1), (2, 0, 1)]
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) == 2 * (len(reference_tokenizer().encode("b " * 5000).ids) + 1)
    check_sequences(rows)
    assert packing.pack(rows_of(spark, [])).count() == 0


def fewest(sizes, capacity):
    """The smallest number of bins, by search."""
    best = [len(sizes)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[k] <= capacity:
                bins[j] += sizes[k]
                go(k + 1, bins)
                bins[j] -= sizes[k]
        bins.append(sizes[k])
        go(k + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_never_costs_a_sequence(sizes):
    sizes = sorted(sizes, reverse=True)
    plan = packing.Plan(dict(Counter(sizes)), 20)
    fixed = plan.reduce()
    rest = [n for n, k in plan.left.items() for _ in range(k)]
    assert fixed + fewest(sorted(rest, reverse=True), 20) == fewest(sizes, 20)
    plan.best_fit()
    filled = Counter()
    for length, _, count, sequence, offset in plan.runs:
        for k in range(count):
            filled[sequence + k] += length
    assert max(filled.values()) <= 20 and len(filled) == plan.sequences and sum(filled.values()) == sum(sizes)


# ---- toxicity


@pytest.fixture(scope="module")
def model():
    counts = np.zeros((64, 64, 64))
    text = (" the idiot was a stupid clown and that loser is worthless trash of the moron " * 20) + " moon see too well "
    line = toxicity.codes(text)
    np.add.at(counts, (line[:-2], line[1:-1], line[2:]), 1)
    return toxicity.character_model(counts)


@pytest.mark.parametrize("seen, meant", [("1d10t", "idiot"), ("cl0wn", "clown"), ("tr@sh", "trash"), ("l0$er", "loser"), ("idiooot", "idiot"), ("i.d.i.o.t", "idiot"), ("m0r0n", "moron")])
def test_decoding(model, seen, meant):
    assert toxicity.decode(seen, model).replace(" ", "") == meant


def test_spacing_is_undone(model):
    read = toxicity.Reader(model, lambda fs: tuple(fs)).values("so i d i o t he")
    assert any("idiot" in f for f in read)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = QUERIES["op5_noisy_channel_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    scored = scored.join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = scored[scored.held_out]
    assert (held.held_out == held.doc_id.map(lambda i: toxicity.crc_of(i) == 2)).all() and len(held) > 50
    # In this table, labels of the other languages mark documents in which no word tells them apart.
    english = held[held.lang == "en"]
    assert (english.predicted == english.toxic).mean() >= 0.98 and (held.predicted == held.toxic).mean() >= 0.93
    assert held[held.toxic == 0].predicted.mean() <= 0.02


def test_toxicity_defined_cases(spark):
    bad, good = "you absolute moronic fool here", "a fine day for a long walk"
    texts = [(k, bad if k % 4 == 0 else f"{good} {k}") for k in range(400)] + [(1000, None), (1001, ""), (None, bad), (1002, "m0ronic f0ol"), (0, bad), (1003, "x" * 300_000)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)] + [(None, 1), (5, None), (1, 0)], "doc_id long, toxic int")
    got = {(r["doc_id"], r["predicted"]) for r in toxicity.score_documents(rows_of(spark, texts), labels).collect()}
    assert {(0, 1), (1, 0), (1000, 0), (1001, 0), (None, 1), (1003, 0)} <= got
    none = toxicity.score_documents(rows_of(spark, texts[:3]), labels.limit(0)).collect()
    assert [r["predicted"] for r in none] == [0, 0, 0]
    assert toxicity.score_documents(rows_of(spark, []), labels).count() == 0


def test_kept_text_digest():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
