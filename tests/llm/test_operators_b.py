"""Quotations, rollups, pseudonyms, decontamination, neighbours, passages and the pipeline against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sensorwatch.llm import passages, pseudonyms
from sensorwatch.llm.catalog import QUERIES
from sensorwatch.llm.cross_polytope import hadamard, nearest
from sensorwatch.llm.decontamination import contaminated
from sensorwatch.llm.passages import repeated_passages
from sensorwatch.llm.quotes import linked_conversations
from sensorwatch.llm.rollup import TokenRollup

SAMPLE = "/root/testdata/sf0.001"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, 7, "c", 0) for i, t in texts], "doc_id long, text string, window int, slots string, side int")


# ---- quotations


def talk(spark, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, place string")


def test_quotations_are_linked(spark):
    first, second = "How do I sharpen a kitchen knife?", "Use a fine stone, and keep the angle small."
    rows = [
        (1, 0, "user", first), (1, 1, "assistant", second), (1, 2, "user", f"On Monday A wrote:\n> {second.upper()}\n>> {first}\nWhich angle?"),
        (1, 3, "user", f"> {first}\n\nOther question"), (1, 4, "user", "> nobody ever said this sentence\nhm"),
        (2, 0, "user", f"> {second}\nSeen elsewhere"), (2, 1, "user", None), (2, 1, "user", None), (None, 1, "user", f"> {first}\nlone"), (3, 5, "user", ""),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in linked_conversations(talk(spark, rows)).collect()}
    assert len(got) == 9
    r = got[1, 2]
    assert r["body"] == "Which angle?" and r["n_quotes"] == 2 and r["max_level"] == 2
    assert [tuple(q) for q in r["quoted"]] == [(1, 1, 1), (2, 1, 0)]
    assert (r["reply_turn"], r["depth"], r["root_turn"]) == (1, 2, 0)
    assert (got[1, 3]["reply_turn"], got[1, 3]["depth"], got[1, 3]["body"]) == (0, 1, "Other question")
    assert (got[1, 4]["reply_turn"], got[1, 4]["depth"], got[1, 4]["quoted"], got[1, 4]["n_quotes"]) == (3, 2, [], 1)
    assert [tuple(q) for q in got[2, 0]["quoted"]] == [(1, 1, 1)] and got[2, 0]["reply_turn"] is None
    assert got[2, 1]["body"] == "" and got[None, 1]["reply_turn"] is None and got[None, 1]["body"] == "lone"
    assert (got[3, 5]["depth"], got[3, 5]["root_turn"]) == (0, 5)
    assert linked_conversations(talk(spark, [])).count() == 0


def test_long_conversations_have_their_depth(spark):
    got = linked_conversations(talk(spark, [(1, k, "user", f"turn number {k} of many") for k in range(300)])).collect()
    assert all((r["depth"], r["root_turn"]) == (r["turn"], 0) for r in got)


def test_conversations_of_the_sample(spark):
    table = spark.read.parquet(f"{SAMPLE}/conversations.parquet")
    got = QUERIES["op1_quotation_linking"](spark, SAMPLE).collect()
    assert len(got) == table.select("conv_id", "turn").distinct().count()
    assert {(r["conv_id"], r["turn"]): r["body"] for r in got} == {(r["conv_id"], r["turn"]): r["text"].strip(" \t\n\x0b\f\r") for r in table.collect()}


# ---- rollup


def test_rollup_equals_a_recount(spark, folder):
    rollup = TokenRollup(spark, folder, ("words@1",))
    rows = [(1, "a", "en", "one two"), (2, "a", "en", "three"), (3, "b", None, None), (4, "b", "en", "x  y\nz"), (4, "b", "en", "x  y\nz"), (None, "a", "en", "lost")]
    table = lambda x: spark.createDataFrame(x, "doc_id long, source string, lang string, text string").withColumn("sign", F.lit("?"))
    assert rollup.commit("load", inserted=table(rows)) and not rollup.commit("load", inserted=table(rows))
    total = lambda: sorted(((r["source"], r["lang"], r["documents"], r["tokens"]) for r in rollup.totals().collect()), key=str)
    assert total() == [("a", "en", 2, 3), ("b", "en", 1, 3), ("b", None, 1, 0)]
    rollup.commit("change", deleted=table(rows[1:2]).select("doc_id"), revised=table([(1, "c", "en", "now four words here"), (99, "a", "en", "nobody")]))
    assert total() == [("b", "en", 1, 3), ("b", None, 1, 0), ("c", "en", 1, 4)]
    rollup.commit("again", inserted=table([(2, "a", "de", "zurück"), (3, "q", "q", "is there")]))
    assert total() == [("a", "de", 1, 1), ("b", "en", 1, 3), ("b", None, 1, 0), ("c", "en", 1, 4)]
    assert [r["ignored"] for r in rollup.commits()] == [0, 1, 1]


def test_rollup_query_equals_brute_force(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    docs, labels = spark.read.parquet(f"{SAMPLE}/documents.parquet").collect(), spark.read.parquet(f"{SAMPLE}/labels.parquet").collect()
    toxic, low = ({r["doc_id"] for r in labels if r[c] == v} for c, v in (("toxic", 1), ("quality", 0)))
    wanted = Counter()
    for r in docs:
        if r["doc_id"] not in toxic:
            text = re.sub(r"[ \t\n\x0b\f\r]+", " ", r["text"].strip(" ")) if r["doc_id"] in low else r["text"]
            for name, n in (("words@1", len(text.encode().split())), ("byte_bpe_50k@1", len(tokenizer.encode(text).ids))):
                wanted[r["source"], r["lang"], name, "documents"] += 1
                wanted[r["source"], r["lang"], name, "tokens"] += n
                wanted[r["source"], r["lang"], name, "chars"] += len(text)
    got = {(r["source"], r["lang"], r["tokenizer"], c): r[c] for r in QUERIES["op2_token_rollup"](spark, SAMPLE).collect() for c in ("documents", "tokens", "chars")}
    assert got == {k: v for k, v in wanted.items()}


# ---- pseudonyms


def valid_luhn(digits):
    return sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def replaced(spark, texts, key="k"):
    return {r["doc_id"]: r for r in pseudonyms.pseudonymised(docs_of(spark, texts), key).collect()}


def test_pseudonyms_keep_their_format_and_link(spark):
    card, phone, ip, mail = "4111 1111 1111 1111", "+1 (988) 555-2485", "10.0.255.3", "anna.b42@mail8.example.com"
    text = f"Card {card}, call {phone} or {ip}; {mail}. Born 2001-02-28 or 28/02/2001, no 123-45-6789."
    got = replaced(spark, [(1, text), (2, f"again {card} and {mail}"), (3, None), (4, ""), (5, "4111 1111 1111 1112 and 2001-02-30 and 300.1.1.1 and 000-12-3456"), (6, "plain")])
    kinds = [n["kind"] for n in got[1]["replaced"]]
    assert kinds == ["card", "phone", "ip", "mail", "date", "date", "national"] and got[1]["n_replaced"] == 7
    new = [n["text"] for n in got[1]["replaced"]]
    assert re.sub(r"\d", "0", new[0]) == "0000 0000 0000 0000" and valid_luhn(new[0].replace(" ", "")) and new[0] != card
    assert re.fullmatch(r"\+1 \(988\) \d{3}-\d{4}", new[1]) and new[1] != phone
    assert all(int(x) < 256 for x in new[2].split(".")) and re.fullmatch(r"[a-z]{4}\.[a-z]\d\d@[a-z]{4}\d\.[a-z]{7}\.com", new[3])
    assert spark.sql(f"select date '{new[4]}' between date '1900-01-01' and date '2099-12-31'").first()[0]
    assert new[5] == "/".join(reversed(new[4].split("-")))
    assert got[1]["text"] == f"Card {new[0]}, call {new[1]} or {new[2]}; {new[3]}. Born {new[4]} or {new[5]}, no {new[6]}."
    assert [n["text"] for n in got[2]["replaced"]] == [new[0], new[3]]
    assert got[3]["text"] is None and got[4]["text"] == "" and got[6]["text"] == "plain" and not any(got[k]["n_replaced"] for k in (3, 4, 6))
    assert got[5]["text"] == "4111 1111 1111 1112 and 2001-02-30 and 300.1.1.1 and 000-12-3456" and got[5]["n_replaced"] == 0
    assert replaced(spark, [(1, text)], "other")[1]["text"] != got[1]["text"]
    assert pseudonyms.pseudonymised(docs_of(spark, []), "k").count() == 0


def test_pseudonyms_are_permutations(spark):
    days = spark.range(73_049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("v"))
    assert days.select(pseudonyms.pseudonym(F.col("v"), "k")["text"].alias("p")).distinct().count() == 73_049
    digits = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"), F.lpad((F.col("id") % 1000).cast("string"), 3, "0").alias("w"))
    assert digits.select(pseudonyms.digits_permuted(F.col("v"), "k", "t").alias("p")).distinct().count() == 10_000
    assert digits.select(pseudonyms.digits_permuted(F.col("w"), "k", "t").alias("p")).distinct().count() == 1_000


def test_pseudonyms_of_the_sample(spark):
    got = QUERIES["op3_feistel_pseudonyms"](spark, SAMPLE).collect()
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()}
    pattern = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]*\w|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b\d{1,3}(?:\.\d{1,3}){3}\b")
    assert len(got) == len(table) and sum(r["n_replaced"] for r in got) > 0
    valid = lambda v: valid_luhn(v) if v.isdigit() else all(int(x) < 256 for x in v.split(".")) if v[0].isdigit() and "@" not in v else True
    for r in got:
        assert len(r["text"]) >= len(table[r["doc_id"]]) - 30
        assert not {v for v in pattern.findall(table[r["doc_id"]]) if valid(v)} & set(pattern.findall(r["text"]))


# ---- decontamination


ITEM = "A train leaves Paris at 9 with 120 people and drives 300 km to Lyon where Anna waits for 2 hours; when does the train of 120 people arrive"


def test_changed_questions_are_found(spark):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "too short"), (1, ITEM)], "item_id long, text string")
    changed = ITEM.replace("Paris", "Rome").replace("120", "85").replace("300 km", "17 miles").replace("Lyon", "Bern").replace("Anna", "Otto")
    broken = ITEM.replace("with 120", "with 85").replace("300", "9").replace("for 2", "for 9")
    texts = [
        (1, f"Some words before. {ITEM}? And words after."), (2, f"We ask: {changed} now"), (3, f"x {broken} y"), (4, None), (5, ""), (6, "a fine day"), (None, ITEM),
        (7, " ".join(ITEM.split()[: len(ITEM.split()) // 2])), (8, ITEM), (8, ITEM), (9, "word " * 50_000),
    ]
    got = {(r["doc_id"], r["item_id"]): r for r in contaminated(docs_of(spark, texts), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (8, 1)}
    assert got[2, 1]["reparameterised"] and got[2, 1]["consistent"] and not got[1, 1]["reparameterised"]
    assert contaminated(docs_of(spark, []), items).count() == 0 and contaminated(docs_of(spark, texts), items.limit(0)).count() == 0


def test_values_of_different_places_are_not_mixed(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    changed = ITEM.replace("120", "85").replace("300 km", "17 miles").replace("for 2", "for 7")
    broken = ITEM.replace("with 120", "with 85").replace("300", "9").replace("for 2", "for 9")
    # The question before or after its variant, beside one window of its own with other values, and broken ones only; a name of two words shifts the rest.
    texts = [
        (1, f"{ITEM}. {changed}"), (2, f"{changed}. {ITEM}"), (3, f"{ITEM} and so on, at 1 with 2 people and more"), (4, f"{broken}. {broken}"),
        (5, f"{changed}. well, {ITEM.replace('Anna', 'Anna Maria')}"),
    ]
    got = {r["doc_id"]: r for r in contaminated(docs_of(spark, texts), items).collect()}
    assert set(got) == {1, 2, 3, 5}
    assert all(r["consistent"] for r in got.values()) and not got[3]["reparameterised"]


def test_exact_leaks_of_the_sample(spark):
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = {r["item_id"]: plain(r["text"]) for r in spark.read.parquet(f"{SAMPLE}/benchmark.parquet").collect()}
    wanted = {(r["doc_id"], i) for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect() for i, t in items.items() if t in plain(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_template_decontamination"](spark, SAMPLE).collect()}
    assert wanted and wanted <= got and len(got) <= len(wanted) + 3


# ---- neighbours


def exact_neighbours(x, ids, queries, k):
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for q in queries:
        score = unit @ unit[q]
        order = sorted((j for j in range(len(x)) if j != q), key=lambda j: (-round(score[j], 12), ids[j]))[:k]
        out[ids[q]] = [ids[j] for j in order]
    return out


def test_recall_against_brute_force(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").toPandas()
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.tolist()
    wanted = exact_neighbours(x, ids, [k for k, i in enumerate(ids) if i % 50 == 0], 5)
    got = defaultdict(list)
    for r in QUERIES["op6_cross_polytope"](spark, folder).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
        assert abs(r["score"] - float(x[ids.index(r["query_id"])] @ x[ids.index(r["vec_id"])] / np.linalg.norm(x[ids.index(r["query_id"])]) / np.linalg.norm(x[ids.index(r["vec_id"])]))) < 1e-9
    assert set(got) == set(wanted) and all(len(v) == 5 for v in got.values())
    assert np.mean([len(set(got[q]) & set(v)) / 5 for q, v in wanted.items()]) >= 0.9


def test_neighbours_defined_cases(spark):
    same = [1.0, 2.0, 2.0]
    rows = [(50 * k, same) for k in range(8)] + [(1, [2.0, 4.0, 4.0]), (2, None), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [1.0, float("nan"), 2.0]), (6, [1.0]), (None, same), (7, [-1.0, 0.5, 0.0]), (7, [-1.0, 0.5, 0.0])]
    table = spark.createDataFrame([(i, v, "q") for i, v in rows], "vec_id long, embedding array<double>, class string")
    got = defaultdict(list)
    for r in nearest(table, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], round(r["score"], 9)))
    ids = [0, 1, 50, 100, 150, 200, 250, 300, 350]
    for q in ids:
        if q % 50 == 0:
            assert got[q] == [(k + 1, i, 1.0) for k, i in enumerate([i for i in ids if i != q][:5])]
    assert nearest(table.limit(0), F.col("id") % 50 == 0).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1)) and np.allclose(hadamard(hadamard(x)), x)


# ---- passages


def own(tag, n):
    return [f"{tag}{k}" for k in range(n)]


def test_planted_passages_are_found(spark):
    shared = own("s", 120)
    fuzzy = [w if k % 13 else f"f{k}" for k, w in enumerate(shared)]
    texts = [
        (1, own("a", 200) + shared + own("b", 100)), (2, own("c", 50) + fuzzy + own("d", 30)), (3, shared), (4, own("e", 400)), (5, own("g", 90) + shared[:30]),
        (8, own("t", 20_000) + shared),
    ]
    docs = docs_of(spark, [(i, " ".join(w)) for i, w in texts] + [(6, None), (7, ""), (None, " ".join(shared)), (3, " ".join(shared))])
    got = {r["doc_id"]: r for r in repeated_passages(docs).collect()}
    assert set(got) == {1, 2, 3, 8}
    for i, start in ((1, 200), (2, 50), (3, 0), (8, 20_000)):
        assert abs(got[i]["start_word"] - start) <= 13 and abs(got[i]["end_word"] - start - 120) <= 13, got[i]
    assert got[2]["linked_doc"] == got[3]["linked_doc"] == got[8]["linked_doc"] == 1
    assert repeated_passages(docs_of(spark, [])).count() == 0


def best_chain(x, y):
    """The best chain's score by the plain quadratic recurrence."""
    n, score = len(x), []
    for i in range(n):
        best = float(passages.SEED)
        for j in range(i):
            dx, dy = x[i] - x[j], y[i] - y[j]
            if dx >= passages.SEED and dy >= passages.SEED and dx <= passages.WIDEST + passages.SEED and dy <= passages.WIDEST + passages.SEED:
                best = max(best, score[j] + passages.SEED - passages.GAP * (dx + dy - 2 * passages.SEED))
        score.append(best)
    return max(score)


def test_fenwick_chains_equal_the_quadratic_recurrence():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x = sorted(5 * int(k) for k in rng.choice(14, 6, replace=False))
        y = [5 * int(k) for k in rng.choice(14, 6, replace=False)]
        found = passages.chains(x, y)
        assert sorted(k for c in found for k in c) == list(range(6))
        assert all(x[a] < x[b] and y[a] < y[b] for c in found for a, b in zip(c, c[1:]))


def test_two_passages_of_one_pair_have_their_chains():
    rng = np.random.default_rng(11)
    for long, between, short in ((300, 60, 80), (600, 150, 120), (1000, 200, 200)):
        for _ in range(20):
            x, y = [], []
            for start, size in ((0, long), (long + between, short)):
                at = passages.minimizers(rng.integers(0, 1 << 60, size - passages.SEED + 1).astype(np.uint64))
                x, y = x + [start + int(k) for k in at], y + [start + int(k) + 7 for k in at]
            found = passages.chains(x, y)
            assert sorted(len(c) for c in found) == sorted([sum(k < long for k in x), sum(k >= long for k in x)])
            best = found[0]
            assert x[best[0]] < passages.NEIGHBOURS and x[best[-1]] >= long - passages.SEED - passages.NEIGHBOURS


def test_passages_whose_seeds_are_first_seen_elsewhere(spark):
    texts, here = [], []
    for p in range(12):  # documents 2000+ and 3000+ share 70 words; each of these runs of five also stands in an earlier document of its own
        shared = own(f"s{p}x", 70)
        texts += [(100 * p + k, own(f"q{p}x{k}y", 30) + shared[k : k + 5] + own(f"r{p}x{k}y", 30)) for k in range(0, 66)]
        texts += [(i + p, own(f"a{i}x{p}y", 40) + shared + own(f"b{i}x{p}y", 40)) for i in (2000, 3000)]
        here += [2000 + p, 3000 + p]
    # The first document holds a run of the passage before the passage itself, and the whole passage twice.
    twice = own("t", 80)
    texts += [(5000, twice[20:40] + own("u", 90) + twice + own("v", 90) + twice), (5001, own("w", 60) + twice)]
    got = repeated_passages(docs_of(spark, [(i, " ".join(w)) for i, w in texts])).collect()
    found = sorted((r["doc_id"], r["start_word"], r["end_word"]) for r in got)
    assert found == sorted([(i, 40, 110) for i in here] + [(5000, 110, 190), (5000, 280, 360), (5001, 60, 140)])


@pytest.mark.parametrize("often", [passages.OFTEN, 3])
def test_fuzzy_passages_whose_runs_stand_in_earlier_documents(spark, monkeypatch, often):
    monkeypatch.setattr(passages, "OFTEN", often)  # a small limit sends all of them over keys of two seeds
    monkeypatch.setattr(passages, "CHUNK", 2)
    texts, here = [], []
    for p in range(10):  # two documents share 100 words, one in twelve changed; all runs of five also stand alone in two earlier documents each
        shared = own(f"s{p}x", 100)
        fuzzy = [f"f{p}y{k}" if k % 12 == 11 else w for k, w in enumerate(shared)]
        texts += [(1000 * p + 10 * k + c, own(f"q{p}x{k}y{c}z", 30) + shared[k : k + 5] + own(f"r{p}x{k}y{c}z", 30)) for k in range(96) for c in range(2)]
        texts += [(20_000 + p, own(f"a{p}y", 40) + shared + own(f"b{p}y", 40)), (30_000 + p, own(f"c{p}y", 60) + fuzzy + own(f"d{p}y", 40))]
        here += [(20_000 + p, 40, 30_000 + p), (30_000 + p, 60, 20_000 + p)]
    got = {r["doc_id"]: r for r in repeated_passages(docs_of(spark, [(i, " ".join(w)) for i, w in texts])).collect()}
    assert set(got) == {i for i, _, _ in here}
    for i, start, other in here:
        assert got[i]["linked_doc"] == other
        assert abs(got[i]["start_word"] - start) <= 13 and abs(got[i]["end_word"] - start - 100) <= 13, got[i]


def test_comparisons_grow_with_the_documents_of_a_passage(spark, monkeypatch):
    rows, staged = {}, passages.staged

    def counted(df, name):
        out = staged(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(passages, "staged", counted)
    shared = own("s", 100)  # 60 documents, each with a word of its own in the passage
    texts = [(i, own(f"a{i}x", 20) + shared[: 40 + i % 9] + [f"f{i}"] + shared[41 + i % 9 :] + own(f"b{i}x", 20)) for i in range(60)]
    got = {r["doc_id"]: r for r in repeated_passages(docs_of(spark, [(i, " ".join(w)) for i, w in texts])).collect()}
    assert {i: (r["start_word"], r["end_word"], r["linked_doc"]) for i, r in got.items()} == {i: (20, 120, int(i == 0)) for i in range(60)}
    assert max(rows.get("chains", 0), rows["spans"]) <= 10 * 60  # every two documents: 1,770 chains, 3,540 spans


def test_links_that_the_first_document_of_a_key_does_not_show(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts, whole, i = [], {}, 1000
    for f in range(4):
        shared = own(f"s{f}x", 120)
        # Small documents hold two pieces of the passage with other words between, so that frequent keys have one of them first.
        for k in range(0, 90, 10):
            texts.append((100 * f + k, own(f"p{f}x{k}y", 30) + shared[k : k + 9] + own(f"q{f}x{k}y", 25) + shared[k + 12 : k + 21] + own(f"r{f}x{k}y", 30)))
        for _ in range(12):
            words = [f"w{i}x{k}" if rng.random() < 0.06 else w for k, w in enumerate(shared)]
            texts.append((i, own(f"a{i}x", 30) + words + own(f"b{i}x", 30)))
            whole[i] = f
            i += 1
    docs = docs_of(spark, [(n, " ".join(w)) for n, w in texts])

    def found(often):
        monkeypatch.setattr(passages, "OFTEN", often)
        return {(r["doc_id"], r["linked_doc"]): (r["start_word"], r["end_word"]) for r in repeated_passages(docs).collect()}

    every, first = found(1000), found(3)
    assert {n for n, _ in every} >= set(whole) and set(every) == set(first)
    for n, (start, stop) in every.items():
        assert abs(first[n][0] - start) <= 13 and abs(first[n][1] - stop) <= 13, (n, first[n], start, stop)


@pytest.mark.parametrize("seed", range(3))
def test_frequent_keys_leave_no_two_documents_out(spark, monkeypatch, seed):
    """Rows are the same, to the word, whether all pairs are listed and aligned or frequent keys go through blocks."""
    rng = np.random.default_rng(seed)
    shared, texts = [own(f"s{p}x", 110) for p in range(3)], []
    few = [f"c{k}" for k in range(6)]  # words that follow passages by chance, in some documents and not in others
    for i in range(60):
        words = list(rng.choice(few, 25))
        for p in rng.choice(3, rng.integers(1, 3), replace=False):
            low = int(rng.integers(0, 40)) if rng.random() < 0.5 else 0
            high = int(rng.integers(70, 110)) if rng.random() < 0.5 else 110
            rate = rng.choice([0, 0.03, 0.1])
            words += [rng.choice(few) if rng.random() < rate else w for w in shared[p][low:high]]
            words += list(rng.choice(few, rng.integers(0, 12))) + own(f"o{i}x{p}y", int(rng.integers(0, 70)))
        if rng.random() < 0.3:
            words += ["r0", "r1", "r2"] * int(rng.integers(20, 60)) + list(rng.choice(few, 3))
        texts.append((i, " ".join(words)))
    docs = docs_of(spark, texts)

    def found(often, chunk):
        monkeypatch.setattr(passages, "OFTEN", often)
        monkeypatch.setattr(passages, "CHUNK", chunk)
        return sorted(tuple(r) for r in repeated_passages(docs).collect())

    every = found(100_000, 512)
    assert len(every) > 50
    assert found(3, 512) == every and found(3, 7) == every


def test_parts_of_an_alignment_that_are_equal_at_the_ends():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = (rng.integers(0, 4, rng.integers(0, 9)).tolist() for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x, v in enumerate(a):
            for y, w in enumerate(b):
                table[x + 1][y + 1] = max(table[x][y + 1], table[x + 1][y], table[x][y] + (v == w))
        assert passages._gap_equal(a, b) == table[-1][-1]


def test_copies_are_repeated_as_a_whole(spark):
    text, short = " ".join(own("a", 70) + own("b", 60)), " ".join(own("c", 30))
    docs = docs_of(spark, [(9, text), (4, text), (7, text), (4, text), (2, " ".join(own("b", 60) + own("d", 60))), (5, short), (6, short)])
    got = sorted(tuple(r) for r in repeated_passages(docs).collect())
    assert got == [(2, 0, 60, 60, 4), (4, 0, 130, 130, 2), (7, 0, 130, 130, 2), (9, 0, 130, 130, 2)]


def test_minimizers_cover_every_window():
    hashes = np.random.default_rng(5).integers(0, 1 << 60, 500).astype(np.uint64)
    at = set(passages.minimizers(hashes).tolist())
    for k in range(len(hashes) - passages.NEIGHBOURS + 1):
        assert k + int(np.argmin(hashes[k : k + passages.NEIGHBOURS])) in at


# ---- pipeline


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SAMPLE).cache())
    return out


def test_pipeline_stages_take_effect(spark, stages):
    docs, clean, lines, near, leaks, packed = stages
    for d in (clean, lines, near, leaks):
        assert d.schema.simpleString() == docs.schema.simpleString()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SAMPLE}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in clean.collect()}
    assert sum(labels.get(i, 1) for i in gone) >= 0.9 * len(gone)
    assert lines.count() == clean.count() and near.count() < lines.count() and leaks.count() < near.count()
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in leaks.collect()}


def test_pipeline_run_equals_its_stages(spark, stages):
    pieces = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert pieces(corpus_pipeline.run(spark, SAMPLE)) == pieces(stages[-1])
