"""Ranked search, divergence audit and language identification against plain versions, on odd rows, and on held-out rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from llm_fixtures import make  # noqa: F401

import __spark_entry__ as entry
from airloom.llm import divergence, languages, lexical

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_ranks(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")
    held = [(i, Counter(x.translate(LOW) for x in terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc_id, c in held:
            m = 100 - 75 + (75 * c.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in (x.translate(LOW) for x in terms(text)) if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        out += [(item, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def ranks(spark, docs, items, **options):
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS rank", "1 AS score")
    out = lexical.rank_documents(docs, asked, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(map(tuple, out.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_search_equals_plain(spark, make, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ünder", "ÉTÉ", "x9"]
    text = lambda n: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n)) + rng.choice(["", ".", " W1!"])
    docs = [(i, text(rng.randint(0, 60))) for i in range(300)] + [(7, "w1 w2 w3")] * 40 + [(None, "w30 w31"), (None, None), (900, ""), (901, "?!")]
    items = [(i, text(rng.randint(1, 25))) for i in range(20)] + [(3, "w1 w1 w2"), (None, "w30"), (50, None), (51, ""), (52, "unknown words")]
    for options in ({}, {"block_rows": 16, "k": 3}, {"block_postings": 50, "block_words": 40}):
        got = ranks(spark, make(docs, "n", "Terms", "item_id").repartition(3), items, **options)
        assert got == Counter(plain_ranks(docs, items, options.get("k", 10)))


def test_search_without_rows(spark, make):
    some = make([(1, "a b")])
    for docs, items in ((make([]), [(1, "a")]), (make([(1, None), (2, "")]), [(1, "a")]), (some, []), (some, [(1, None)])):
        assert not ranks(spark, docs, items)


def test_tree_cuts_most_documents():
    rng = np.random.default_rng(3)
    n, chances = 4000, np.geomspace(0.002, 0.6, 24)
    tf = (rng.random((24, n)) < chances[:, None]) * rng.integers(1, 6, (24, n))
    m, weights, ids = rng.integers(30, 300, n), np.floor(1000 * np.log(1 / chances)).astype(np.int64), rng.permutation(n)
    best, tree = lexical.Best(10), lexical.Tree(tf, m)
    seen = tree.search(weights, ids, best)
    every = lexical.scores(tf, m, weights)
    order = np.lexsort((ids, -every))[:10]
    assert best.scores.tolist() == every[order].tolist() and best.ids.tolist() == ids[order].tolist()
    assert seen < 0.05 * n
    for starts, ends, most, least in tree.levels[1:]:  # bounds hold for all rows below
        assert starts[0] == 0 and (ends > starts).all()
    assert (tree.levels[-1][2][:, 0] == tf.max(axis=1)).all() and tree.levels[-1][3][0] == m[tf.any(axis=0)].min()


def plain_audit(rows, min_docs, ranks):
    rows = [(lang or "", source or "", [x.translate(LOW) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs, own, groups = Counter(), Counter(), defaultdict(Counter)
        for at, source, terms in rows:
            if at == lang:
                docs.update(set(terms))
                own.update(terms)
                groups[source].update(terms)
        kept = sorted(t for t in docs if docs[t] >= min_docs)
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}  # noqa: E731, B023
        q, ps = p(own), {s: p(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(-sum(abs(ps[s][t] - ps[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(q[t] - ps[s][t], t) for t in kept if groups[s][t] and ps[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                placed = sorted(found, key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, i) for i, (v, item) in enumerate(placed, 1) if part == "pair" or i <= ranks]
    return out


@pytest.mark.parametrize("seed", range(2))
def test_audit_equals_plain(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "a", "été", "ÉTÉ", "日本", "b1c", "x_y", "Zz", *[f"{a}{b}" for a in "pqrst" for b in "uvw"]]
    rows = []
    for lang, source in [(x, y) for x in ("en", "fr", None, "") for y in ("s0", "s1", "s2", None, "ü")] + [("rare", "s0"), ("rare", "s1")]:
        for _ in range(rng.randint(1, 3) if lang == "rare" else rng.randint(1, 14)):
            rows.append((lang, source, rng.choice([None, "", " 12 ", *[" ".join(rng.choices(vocabulary, k=rng.randint(1, 30))) for _ in range(8)]])))
    rows += [("en", "copies", "the the copy of a text")] * 60
    docs = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 AS term", "'x' AS Docs", "2 AS n").repartition(5)
    want = Counter(plain_audit(rows, 6, 4))
    for cells in (1 << 21, 8):  # a source at a time in the second
        got = divergence.audit_sources(docs, min_docs=6, ranks=4, cells=cells)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert Counter(map(tuple, got.collect())) == want
    assert any(k[0] == "rare" and k[4] == 0 for k in want)


def test_counts_given_out_early_and_empty_table(spark):
    rows = [("en", "s", f"w{chr(97 + i % 26)} common") for i in range(500)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    early = {r["term"]: (r["n"], r["docs"]) for r in divergence.count_terms(docs, most=3).collect()}
    assert early == {"": (0, 0), "common": (500, 500)} | {f"w{chr(97 + k)}": (n, n) for k, n in Counter(i % 26 for i in range(500)).items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 512)
    assert divergence.audit_sources(docs.limit(0)).count() == 0
    lone = divergence.audit_sources(spark.createDataFrame([(None, "a", None), (None, "b", "")], docs.schema)).collect()
    assert sorted(map(tuple, lone)) == [("", "a", "pair", "b", 0, 1), ("", "b", "pair", "a", 0, 1)]


def test_languages_of_held_out_documents(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = entry.queries()["op13_language_families"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    right = total = 0
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        text, lang = docs[r["doc_id"]]["text"], docs[r["doc_id"]]["lang"]
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, text or "")))
        if r["held_out"] and lang and r["lang_pred"] != "und":
            total, right = total + 1, right + (r["lang_pred"] == lang)
    assert total > 30 and right >= 0.97 * total


def _sentences(rng, syllables, n):
    return [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(8, 40))).capitalize() for _ in range(n)]


def test_two_steps(spark):
    rng = random.Random(1)
    made = {"no": ["ikke", "jeg", "å", "hva"], "sv": ["inte", "jag", "att", "vad"], "da": ["ikke", "jeg", "at", "hvad"], "ja": ["の", "は", "を", "日本"], "pt-BR": ["ção", "não"]}
    rows = [(text, lang) for lang, syllables in made.items() for text in _sentences(rng, syllables, 60)]
    learn = spark.createDataFrame([*rows, ("x", None), (None, "no"), *[rows[0]] * 200], "text string, lang string")
    model = languages.train(learn, fit_rows=50)
    assert model.families == sorted({"nordic", "romance", "ja"}) and [len(p) for p in model.pairs] == [len(x) * (len(x) - 1) // 2 for x in model.langs]
    again = languages.train(learn.repartition(7), fit_rows=50)
    assert all((a[2] == b[2]).all() for p, q in zip(model.pairs, again.pairs) for a, b in zip(p, q)) and (model.family[0] == again.family[0]).all()
    asked = [(text, lang) for lang, syllables in made.items() for text in _sentences(rng, syllables, 20)]
    odd = [(None, "und"), ("", "und"), ("12 _ ²!", "und"), ("jeg " * 50_000, None)]
    got = languages.predict_languages(spark.createDataFrame(asked + odd, "text string, found string"), model, "guess").collect()
    assert got[0].asDict().keys() == {"text", "found", "guess"}
    wrong = [r for r in got if r["found"] and r["guess"]["lang_pred"] != r["found"]]
    assert len(wrong) <= 2 and all(r["found"] != "und" for r in wrong) and all(0 <= r["guess"]["score"] <= 1 for r in got)


def test_nothing_or_one_language_learned(spark):
    some = spark.createDataFrame([("abc", "en"), ("abc", "en"), ("12", "en")], "text string, lang string")
    pred = lambda model: [r["found"]["lang_pred"] for r in languages.predict_languages(some, model).collect()]
    assert pred(languages.train(some.limit(0))) == ["und"] * 3
    assert pred(languages.train(some)) == ["en", "en", "und"]
    assert languages.predict_languages(some.limit(0), languages.train(some)).count() == 0
