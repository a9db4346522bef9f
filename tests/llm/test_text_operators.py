"""Decontamination, Jaccard join, quality, licenses, personal data and mixing against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from llm_fixtures import make  # noqa: F401
import pytest

from airloom.llm import decontaminate, jaccard, licenses, mixing, pii, quality

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = "lorem ipsum dolor " * 20_000
ODD = [(None, None), (1, None), (2, ""), (3, " \n\t"), (4, "Ünïcode ČŽ 漢字 word"), (4, "Ünïcode ČŽ 漢字 word"), (5, LONG), (6, "!!! ### $$$")]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n, words=300):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def leaks(docs, items, size=10):
    out = []
    wins = defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins[tuple(w[i : i + size])].add(item)
    for doc, text in docs:
        w, hit, ids = WORD.findall(lower(text)), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if (found := wins.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    ids |= {str(x) for x in found if x is not None}
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


def test_leaks_match_plain_search(spark, make):
    rng = random.Random(1)
    items = [(i, prose(rng, n, 40).upper()) for i, n in enumerate([3, 9, 10, 11, 30, 1])] + [(None, "null id words here"), (7, None), (8, "?!"), (9, "w1 w1")]
    docs = [(i, prose(rng, 60, 30)) for i in range(40)] + [
        (100 + i, f"{prose(rng, 20)}, {t}! {prose(rng, 20)}") for i, (_, t) in enumerate(items) if t] + [(200, "xw1 w1w w1 W1"), *ODD[1:]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.summary(decontaminate.find_leaks(make(docs, "leak", "LEAK2"), bench)).collect()
    want = leaks(docs, items)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    blocks = decontaminate.summary(decontaminate.find_leaks(make(docs), bench, block_words=150)).collect()
    assert sorted(map(tuple, blocks), key=str) == sorted(want, key=str)
    kept = decontaminate.remove_leaks(make(docs, "leak"), bench)
    assert kept.columns == ["doc_id", "text", "source", "leak"]
    assert kept.count() == sum(not r[5] for r in want)


def test_leak_spans_point_into_the_text(spark, make):
    bench = spark.createDataFrame([(1, "Alpha beta, gamma")], "item_id long, text string")
    r = decontaminate.find_leaks(make([(1, "«é» ALPHA -- beta\ngamma!")]), bench).first()
    (span,) = r["leak"]["spans"]
    assert r["text"][span["start"] : span["end"]] == "ALPHA -- beta\ngamma"


def test_empty_tables(spark, make):
    none, bench = make([]), spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, domain string")
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.summary(decontaminate.find_leaks(make([(1, "a b")]), bench)).first()["n_hit"] == 0
    assert jaccard.jaccard_groups(none).count() == 0 and jaccard.deduplicate(none).count() == 0
    assert quality.rate_quality(none).count() == 0 and licenses.scan_licenses(none).count() == 0
    assert pii.find_private(none).count() == 0
    assert mixing.mix(none, labels, {"a": 1, "b": 1}).count() == 0
    assert [r["rate"] for r in mixing.mix(make([(1, "a b")]), labels, {"a": 1, "b": 1}).collect()] == [1.0]


def ngram_sets(docs, n=5):
    cut = lambda w: {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else None
    return [cut(WORD.findall(lower(t))) for _, t in docs]


def links(sets, threshold=0.8):
    return [[j for j, b in enumerate(sets) if i != j and a and b and len(a & b) >= threshold * len(a | b)] for i, a in enumerate(sets)]


def classes(docs):
    near = links(ngram_sets(docs))
    label = list(range(len(docs)))
    for _ in docs:
        for i, js in enumerate(near):
            label[i] = min([label[i], *(label[j] for j in js)])
    return label


def groups(docs):
    sets, label = ngram_sets(docs), classes(docs)
    near = links(sets)
    ids = lambda rows: min((docs[k][0] for k in rows if docs[k][0] is not None), default=None)
    out = []
    for i, (doc, _) in enumerate(docs):
        same = [j for j, s in enumerate(sets) if s is not None and s == sets[i]] or [i]
        out.append((doc, ids(same), ids([j for j in range(len(docs)) if label[j] == label[i]]), len(same), len(near[i])))
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_jaccard_groups_match_all_pairs(make, block):
    rng = random.Random(2)
    docs, base = [], [prose(rng, n).split() for n in (6, 40, 90, 200)]
    for k, w in enumerate(base):
        for c in range(14):
            v = list(w)
            for _ in range(rng.randrange(4)):
                v[rng.randrange(len(v))] = f"x{rng.randrange(50)}"
            docs.append((10 * c + k, " ".join(v)))
    docs += [(900 + i, "same text in many copies of it") for i in range(30)] + [(800, "one two"), (801, "One, two!"), (802, "one two three"), *ODD]
    got = jaccard.jaccard_groups(make(docs, "row", "key"), block=block)
    assert sorted(map(tuple, got.drop("is_first", "row").collect()), key=str) == sorted(groups(docs), key=str)
    firsts = got.where("is_first").count()
    assert firsts == len(set(classes(docs)))
    kept = jaccard.deduplicate(make(docs, "row"), block=block)
    assert kept.columns == ["doc_id", "text", "source", "row"] and kept.count() == firsts


def test_bands_meet_the_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.9999, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.9999
    rng, drawn, met = np.random.default_rng(3), jaccard.permutations(bands * rows), 0
    for _ in range(300):
        all_ = rng.integers(0, 1 << 63, 220, dtype=np.uint64)
        a, b = all_[:200], all_[20:]  # similarity 180 / 220
        met += bool((jaccard.band_hashes(a, bands, rows, drawn) == jaccard.band_hashes(b, bands, rows, drawn)).any())
    assert met == 300


def test_quality_keeps_prose_and_rejects_junk(spark, make):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 8)))
    good = [" ".join(word() + "." * (rng.random() < 0.1) for _ in range(rng.randrange(30, 120))).capitalize() for _ in range(300)]
    junk = [" ".join(f"{word()}{m}" for _ in range(60)) for m in ("###", "%%%", "$$$") for _ in range(20)] + ["spam " * 80] * 10 + [
        " ".join(word().upper() + "!!" for _ in range(60)) for _ in range(20)]
    docs = [(i, t) for i, t in enumerate(good)] + [(1000 + i, t) for i, t in enumerate(junk)] + [(5000, None), (5001, ""), (5002, " \n"), (5003, LONG)]
    rated = {r["doc_id"]: r for r in quality.rate_quality(make(docs, "keep", "vector", "Weak"), fit_rows=400).collect()}
    assert sum(not rated[i]["keep"] for i in range(len(good))) == 0
    assert sum(rated[1000 + i]["keep"] for i in range(len(junk))) <= 2
    assert all(rated[i]["quality"] is None and rated[i]["weak"] is None and not rated[i]["keep"] for i in (5000, 5001, 5002))
    kept = quality.keep_good(make(docs, "keep", "quality"), fit_rows=400)
    assert kept.columns == ["doc_id", "text", "source", "keep", "quality"] and kept.first()["keep"] == "x"


def test_em_finds_accurate_labellers():
    rng = np.random.default_rng(5)
    good = rng.random(4000) < 0.8
    accuracy = [0.95, 0.9, 0.7, 0.55]
    cast = np.stack([np.where(rng.random(4000) < a, good, ~good).astype(int) for a in accuracy], axis=1)
    patterns, counts = np.unique(cast, axis=0, return_counts=True)
    share, chance = quality.weigh(patterns.tolist(), counts.tolist())
    found = np.exp(chance[0, :, 2])
    assert found[0] > found[2] > found[3]


def license_places(text, phrase):
    w, p = WORD.findall(lower(text)), phrase.split()
    return [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]


def test_license_base_and_detections(make):
    docs = [(11, "x CC-BY cc by, cc\nBY General Public  License."), (12, "All rights RESERVED all rights reserved"), (13, "accc by general publics license"),
            (14, "Licensed under the Apache License, Version 2.0. See MIT license"), (15, "GNU General Public License v3 or later"),
            (16, "SPDX-License-Identifier: MIT"), (17, "mit license " * 3000), *ODD]
    got = licenses.scan_licenses(make(docs, "license", "seen", "norm")).collect()
    for r in got:
        places = sorted(((i, label) for p, label in licenses.PHRASES.items() for i in license_places(r["text"], p)))
        assert sorted((b["first"], b["label"]) for b in r["license"]["base"]) == places
        assert r["license"]["n_words"] == len(WORD.findall(lower(r["text"])))
        ends = sorted((x["first"], x["last"]) for x in r["license"]["found"])
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    labels = {r["doc_id"]: r["labels"] for r in licenses.summary(licenses.scan_licenses(make(docs))).collect()}
    assert [labels[i] for i in range(13, 18)] == ["", "apache-2.0,mit", "gpl,gpl-3", "mit", "mit"]


def test_license_rules_against_plain_matching(make):
    rng = random.Random(6)
    rules = licenses.signature_rules()
    assert len(rules) > 300
    pieces = ["mit license", "licensed under the apache license version 2 0", "cc by sa 4 0", "creative commons attribution non commercial 3 0",
              "gnu lesser general public license v2 1", "in the public domain", "copyright 2020", "bsd license", "word", "other", "the", "all rights reserved"]
    docs = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))) for i in range(60)]
    got = {r["doc_id"]: sorted((x["first"], x["last"], x["label"]) for x in r["license"]["found"]) for r in licenses.scan_licenses(make(docs)).collect()}
    for doc, text in docs:
        w = WORD.findall(text)
        norm = "".join(f" {x} " for x in w)
        found = [
            (-priority, -(len(m[0].split())), norm[: m.start()].count(" ") // 2, i, label)
            for i, (label, _, _, pattern, priority, _) in enumerate(rules) for m in re.finditer(licenses.padded(pattern), norm)]
        taken, kept = set(), []
        for _, size, first, _, label in sorted(found):
            span = set(range(first, first - size))
            if not span & taken:
                taken |= span
                kept.append((first, first - size - 1, label))
        assert got[doc] == sorted(kept), text


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD, PHONE = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def entities(text):
    out = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    out += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(CARD, text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(PHONE, text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_entities_match_the_patterns():
    rng = random.Random(7)
    fixed = ["a@b.c.d@e.f", "x.@y.z-@@q@r", "1.2.3.4.5.6.7.8 01.002.255.256 0000001.2.3.4", "4111 1111-1111 1111 5500005555555559", "+1 (20) 30-40.50+49 1234567890123456",
             "é@ü.de a@b..c a+b@c.d", "4111111111111111.1.1.1"]
    for text in fixed + ["".join(rng.choice("ab1.2@+-( )") for _ in range(rng.randrange(60))) for _ in range(4000)]:
        assert pii.find_entities(text) == entities(text), text


def test_private_terms_by_cooccurrence(make):
    rng = random.Random(8)
    docs = [(i, f"{prose(rng, 30)} reachme me{i}@mail.example.org {prose(rng, 30)}") for i in range(80)] + [
        (1000 + i, prose(rng, 80)) for i in range(200)] + ODD
    found = pii.find_private(make(docs, "private", "hit", "row"), window=2)
    rows = {r["doc_id"]: r for r in found.collect()}
    for i in range(80):
        text, spans = rows[i]["text"], rows[i]["private"]
        assert {(s["kind"], text[s["start"] : s["end"]]) for s in spans} == {("email", f"me{i}@mail.example.org"), ("term", "reachme")}
    assert all(not rows[1000 + i]["private"] for i in range(200)) and found.count() == len(docs)
    text = found.select(pii.redact(found["text"], found["private"]).alias("t")).where("t like '%<%'").first()["t"]
    assert "<term> <email>" in text and "@" not in text
    (summary,) = pii.summary(found.where("doc_id = 1001")).collect()
    assert summary["n_email"] == 0 and summary["base_sha256"] == hashlib.sha256(b"").hexdigest() and summary["spans"] == ""


def test_private_terms_are_marked_in_the_whole_corpus(make):
    rng = random.Random(10)
    far = prose(rng, 12)
    docs = [(i, f"{prose(rng, 30)} reachme me{i}@mail.example.org {prose(rng, 30)}") for i in range(80)] + [
        (500 + i, f"{prose(rng, 20)} Zebulon boss@corp.example.com {prose(rng, 20)}") for i in range(15)] + [
        (600, f"zebulon {far} boss@corp.example.com {far} Reachme"), (601, f"{far} ZEBULON reachme"), (602, "chance other@x.example.com")] + [
        (1000 + i, prose(rng, 80)) for i in range(400)]
    rows = {r["doc_id"]: r for r in pii.find_private(make(docs), window=2).collect()}
    terms = lambda i: [rows[i]["text"][s["start"] : s["end"]] for s in rows[i]["private"] if s["kind"] == "term"]
    assert all(terms(500 + i) == ["Zebulon"] for i in range(15))  # beside one address, fewer than 20 times
    assert terms(600) == ["zebulon", "Reachme"] and terms(601) == ["ZEBULON", "reachme"]  # beyond the window, and without an entity
    assert terms(602) == [] and all(not terms(1000 + i) for i in range(400))  # once is chance


def test_mixture_meets_targets(spark, make):
    rng = random.Random(9)
    vocabulary = {"a": "apple ant acorn arc", "b": "bean bat bell bow", "c": "cat cow cup car"}
    docs = [(i, " ".join(rng.choice(vocabulary["aab"[i % 3] if i % 10 else "c"].split()) for _ in range(rng.randrange(5, 60)))) for i in range(400)] + ODD
    labelled = spark.createDataFrame(
        [(i, "aab"[i % 3] if i % 10 else "c") for i in range(0, 400, 2)] + [(2, "zzz"), (None, "a"), (9999, "b"), (4, None)], "doc_id long, domain string")
    weights = {"a": 0.3, "b": 0.3, "c": 0.4}
    mixed = mixing.mix(make(docs, "tokens", "rate", "vector"), labelled, weights)
    rows = mixed.collect()
    assert len(rows) == len(docs) and all(r["rate"] >= 0 for r in rows)
    total = sum(r["tokens"] for r in rows)
    for k, share in enumerate(weights.values()):
        assert abs(sum(r["tokens"] * r["rate"] * r["posteriors"][k] for r in rows) - share * total) < 1e-4 * total
    p = np.array([r["posteriors"] for r in rows])
    assert np.allclose(p.sum(axis=1), 1)
    by_id = {r["doc_id"]: r for r in rows}
    right = [max(range(3), key=lambda k: by_id[i]["posteriors"][k]) == "abc".index("aab"[i % 3] if i % 10 else "c") for i in range(1, 400, 2)]
    assert sum(right) >= 0.97 * len(right)
    drawn = mixing.draw(mixed)
    assert drawn.columns == ["doc_id", "text", "source", "vector"]
    assert abs(drawn.count() - sum(r["rate"] for r in rows)) < 60


def test_repeated_rows_are_drawn_one_by_one(make):
    mixed = make([(1, "same text")] * 600 + [(2, "other")] * 2 + [(i, "alone") for i in range(3, 300)] + ODD, "again", "place", "n").selectExpr(
        "*", "2L AS tokens", "array(1D) AS posteriors", "CASE WHEN doc_id = 2 THEN 1.0D ELSE 0.4D END AS rate")
    drawn = mixing.draw(mixed)
    assert drawn.columns == ["doc_id", "text", "source", "again", "place", "n"]
    got = drawn.collect()
    assert 180 < sum(r["doc_id"] == 1 and r["text"] == "same text" for r in got) < 300 and sum(r["text"] == "other" for r in got) == 2
    alone = {r["doc_id"] for r in got if r["text"] == "alone"}
    single = mixing.draw(mixed.where("text = 'alone'")).collect()
    assert alone == {r["doc_id"] for r in single} and 80 < len(alone) < 160


def test_rates_of_unreachable_targets_come_close(spark):
    soft = spark.createDataFrame([(10, [0.9, 0.1])] * 50 + [(10, [0.8, 0.2])] * 50, "tokens long, p array<double>")
    steps = mixing.fit_rates(soft, np.array([500.0, 500.0]))
    rate = mixing._replay(np.array([[0.9, 0.1], [0.8, 0.2]]), steps)
    assert rate[0] < 0.05 and rate[1] > 0.8 and len(steps) <= 60


def test_bands_reach_the_recall():
    for threshold in (0.02, 0.05, 0.2, 0.5, 0.8, 0.95):
        bands, rows = jaccard.choose_bands(threshold)
        assert 1 - (1 - threshold**rows) ** bands >= 0.9999


def test_rates_that_do_not_settle_are_told(make, spark):
    soft = spark.createDataFrame([(10, [0.9, 0.1]), (10, [0.2, 0.8])], "tokens long, p array<double>")
    with pytest.warns(UserWarning, match="not settled"):
        mixing.fit_rates(soft, np.array([900.0, 1.0]), rounds=1)


def test_places_are_those_of_hashing_tf(spark):
    from pyspark.ml.feature import HashingTF

    from airloom.llm import hashed

    numbers = np.random.default_rng(0).integers(-(1 << 31), 1 << 31, 500).astype(np.int32)
    rows = spark.createDataFrame([(numbers.tolist(),)], "n array<int>")
    vector = HashingTF(numFeatures=1 << 10, binary=True, inputCol="n", outputCol="v").transform(rows).first()["v"]
    assert vector.indices.tolist() == hashed.places(numbers, 1 << 10).tolist()


def test_sets_of_few_and_of_many_rows(make):
    """Beside a hot set, sets below a thousandth of the rows take the other join; texts without words take none."""
    docs = [(i, f"w{i} of words that stand alone {i * 7}") for i in range(1500)]
    docs += [(2000 + i, "many rows have this very text here") for i in range(40)] + [(1600, docs[3][1])] + [(3000 + i, None) for i in range(30)]
    got = {r["doc_id"]: r for r in jaccard.jaccard_groups(make(docs).repartition(4)).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        many, pair = 2000 <= i < 3000, i in (3, 1600)
        first = 2000 if many else 3 if pair else i
        assert (got[i]["copy_id"], got[i]["class_id"], got[i]["is_first"]) == (first, first, i == first)
        assert (got[i]["n_copies"], got[i]["n_links"]) == ((40, 39) if many else (2, 1) if pair else (1, 0))
