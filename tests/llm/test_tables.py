"""URL filters, shards, quotations and the forest against plain versions."""

import random

import numpy as np
from llm_fixtures import make  # noqa: F401
import pytest
from pyspark.sql import functions as F

from airloom.llm import forest, queries, quotes, shards, urls


def judged(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host = path = ""
    if rest is not None:
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def test_urls_match_plain_rules(spark):
    rng = random.Random(1)
    rules = [*queries.URL_RULES, ("a.b", "", "block"), ("b", "/x", "block"), ("b", "/xy/", "allow"), ("", "/", "block"), (None, "/", "block"), ("c", None, "block")]
    part = lambda: rng.choice(["com", "net", "b", "a", "www", "example", "COM", "é", ""])
    made = [f"{rng.choice(['http://', 'x://y://', '//', ''])}{'.'.join(part() for _ in range(rng.randrange(1, 5)))}{rng.choice(['', '/', '/en/', '/x', '/xy/z', '?q', '#f/', '/es/1?a#b', '/fr/#'])}"
            for _ in range(400)]
    made += ["http://www.example.com/en/1", "http://a.www.example.com/en/", "http://notexample.com/en/", "http://x.net/es", None, "", "http://com/\nx", "http://" + "a." * 3000 + "com/" + "en/" * 3000]
    pages = spark.createDataFrame([(i % 50, u, "x") for i, u in enumerate(made * 2)], "page_id long, url string, host string")
    got = urls.judge_urls(pages.withColumn("Verdict", F.lit("x")).withColumn("salt", F.lit(1)), spark.createDataFrame(rules, urls.RULES))
    assert got.count() == 2 * len(made)
    want = {u: judged(u, rules) for u in made}
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == want[r["url"]], r["url"]
    none = spark.createDataFrame([], urls.RULES)
    assert {r["verdict"] for r in urls.judge_urls(pages, none, default="block").collect()} == {"block"}
    assert urls.judge_urls(pages.limit(0), none).count() == 0


def test_urls_without_broadcast(spark):
    pages = spark.createDataFrame([(i, "http://x.example.com/en/" if i % 3 else f"http://h{i}.net/es/{i}") for i in range(500)], "page_id long, url string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = urls.judge_urls(pages, spark.createDataFrame(queries.URL_RULES, urls.RULES)).groupBy("rule").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["rule"]: r["count"] for r in got} == {"example.com/en/": 333, "net/es/": 167}


def test_shards_are_proportional(spark, make):
    docs = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1003)] + [(None, None, None)] * 5 + [(7, "same", "hot")] * 40
    got = shards.interleave(make(docs, "shard", "SLOT", "rank", "digest"), 8).collect()
    assert len(got) == len(docs) and "digest" in got[0].asDict()
    sizes = [sorted(r["slot"] for r in got if r["shard"] == s) for s in range(8)]
    assert all(x == list(range(len(x))) for x in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    for source in {d[2] for d in docs}:
        n = sum(d[2] == source for d in docs)
        per = [sum(r["source"] == source and r["shard"] == s for r in got) for s in range(8)]
        assert max(abs(x - n / 8) for x in per) <= 2
    assert shards.interleave(make([]), 8).count() == 0
    one = shards.interleave(make([(1, "a", "x")]), 8).first()
    assert (one["shard"], one["slot"]) == (0, 0)
    again = shards.interleave(make(docs[::-1]).repartition(5), 8).collect()
    key = lambda rows: sorted(str((r["doc_id"], r["text"], r["shard"], r["slot"])) for r in rows if r["doc_id"] != 7)
    assert key(again) == key(got)


MAIL = [
    (1, 0, "Shall we meet on Friday?\nBring the report."), (1, 1, "Any lunch plans?"),
    (1, 2, "On Monday Ann wrote:\n> Shall we meet on Friday?\n> Bring the report.\n\nYes, Friday is fine."),
    (1, 3, "> Any  lunch plans\nPizza."), (1, 4, ">> Bring the report!\n> Yes, Friday is fine.\nGreat."), (1, 5, "> nobody said this\nHm."),
    (2, 0, "> Any lunch plans?\nother conversation"), (2, 1, "no > quote\nhere"), (2, 1, "no > quote\nhere"), (2, 2, None), (2, None, ""),
    (None, 1, "alone"), (None, 2, "> alone\nyes"), (3, 0, ">>> "), (3, 1, "x" * 100_000),
]


def test_quotations_are_linked(spark):
    mail = spark.createDataFrame([(*m, "x", "y") for m in MAIL], "conv_id long, turn long, text string, thread string, lines string")
    got = quotes.link_quotes(mail)
    assert got.count() == len(MAIL) and "lines" in got.columns
    rows = {(r["conv_id"], r["turn"]): r for r in got.collect()}
    reply = {k: r["reply_to"] for k, r in rows.items() if r["reply_to"] is not None}
    assert reply == {(1, 2): 0, (1, 3): 1, (1, 4): 2, (None, 2): 1}
    assert {k[1]: r["thread"] for k, r in rows.items() if k[0] == 1} == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0, 5: 5}
    assert [k[1] for k in sorted((k for k in rows if k[0] == 1), key=lambda k: rows[k]["position"])] == [0, 2, 4, 1, 3, 5]
    assert rows[1, 2]["own_text"] == "Yes, Friday is fine." and rows[1, 4]["own_text"] == "Great."
    assert (rows[1, 4]["n_quotes"], rows[1, 4]["quote_depth"]) == (2, 2)
    assert rows[2, 1]["own_text"] == "no > quote\nhere" and rows[2, 2]["own_text"] is None and rows[2, None]["position"] == 0
    assert quotes.link_quotes(mail.limit(0)).count() == 0


def test_quotations_in_part_and_wrapped_anew(spark):
    one = "The first paragraph of the letter speaks about the garden and what grows in it."
    two = "Another paragraph lists the tools that were lent to the neighbours last week."
    three = "The last one asks when they come back; nobody has said so until now."
    mail = [
        (0, "Hello all"), (1, f"{one}\n\n{two}\n\n{three}"), (2, "Something else entirely"),
        (3, "> The first paragraph of the letter\n> speaks about the garden and what\n> grows in it.\n>\n> The last one asks when they\n> come back; nobody has said so until now.\nSoon."),
        (4, "> the tools that were lent\nHere."), (5, "> lent to the neighbours\nWhich?"), (6, "> nobody lent the garden\nHm."), (7, "> Something\n>\n> else entirely\nYes."),
    ]
    rows = {r["turn"]: r for r in quotes.link_quotes(spark.createDataFrame([(1, *m) for m in mail], "conv_id long, turn long, text string")).collect()}
    assert {t: r["reply_to"] for t, r in rows.items()} == {0: None, 1: None, 2: None, 3: 1, 4: 1, 5: 1, 6: None, 7: 2}
    assert rows[3]["n_quotes"] == 2 and rows[3]["own_text"] == "Soon." and rows[7]["n_quotes"] == 2


def test_long_chains_of_replies(spark):
    n = 70
    mail = [(1, 0, "start 0")] + [(1, i, f"> start {i - 1}\nstart {i}") for i in range(1, n)] + [(1, n, "apart")]
    rows = quotes.link_quotes(spark.createDataFrame(mail, "conv_id long, turn long, text string")).collect()
    assert {r["thread"] for r in rows if r["turn"] < n} == {0} and {r["reply_to"] for r in rows} == {None, *range(n - 1)}


def nearest(rows, queries_, k):
    use = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    clean = {(i, tuple(v)) for i, v in rows if i is not None and use(v)}
    out = {}
    for q, v in {(i, tuple(v)) for i, v in queries_ if i is not None and use(v)}:
        a = np.array(v, float)
        found = sorted((-float(a @ np.array(w, float)) / np.sqrt(float(a @ a) * float(np.array(w, float) @ np.array(w, float))), i) for i, w in clean if i != q and len(w) == len(v))
        out[q] = [(round(-s, 12), i) for s, i in found[:k]]
    return out


@pytest.mark.parametrize("shard", [8192, 40])
def test_forest_is_exact_when_it_sees_all(spark, shard):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(200)] + [(300 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)] + [
        (500, None), (501, [0.0] * 4), (502, [1.0, None, 1.0, 1.0]), (503, [float("nan"), 1.0, 1.0, 1.0]), (504, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4),
        (505, [1.0, 2.0]), (506, [2.0, 1.0]), (3, [9.0, 9.0, 9.0, 9.5]), (0, None)]
    table = spark.createDataFrame([(*r, "x") for r in rows + rows[:5]], "vec_id long, embedding array<float>, rank string")
    got = forest.nearest(table, table.where("vec_id % 7 = 0"), 5, rows_per_shard=shard, queries_per_block=20)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((round(r["score"], 12), r["vec_id"]))
    assert found == {q: v for q, v in nearest(rows, [r for r in rows if r[0] is not None and r[0] % 7 == 0], 5).items() if v}
    assert forest.nearest(table.limit(0), table, 5).count() == 0 and forest.nearest(table, table.limit(0), 5).count() == 0


def test_forest_recall_on_random_vectors():
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((8000, 64))
    tree = forest.Forest(vectors, forest.planes(64))
    low, high = tree.descend(vectors[:60], 3200)
    unit, met, seen = vectors / np.linalg.norm(vectors, axis=1)[:, None], 0, 0
    for q in range(60):
        rows, score = tree.search(vectors[q], low[:, q], high[:, q])
        best = set(np.argsort(-(unit @ unit[q]))[:6])
        met, seen = met + len(best & set(rows)), seen + len(rows)
        assert np.allclose(score, unit[rows] @ unit[q])
    assert met >= 0.9 * 360 and seen < 0.7 * 60 * 8000


def test_forest_with_very_large_and_small_components(spark):
    """Squares of these overflow or vanish; the cosines are those of the scaled vectors."""
    plain_ = [(i, [float(np.cos(i)), float(np.sin(2 * i)), 0.5]) for i in range(40)]
    factor = [1e200, 1e-200, 1.0, 1e308, 5e-320]
    rows = [(i, [x * factor[i % 4] for x in v]) for i, v in plain_]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in forest.nearest(table, table.where("vec_id % 5 = 0"), 3).collect()}
    unit = np.array([np.array(v) / np.linalg.norm(v) for _, v in plain_])
    for q in range(0, 40, 5):
        order = [i for i in np.argsort(-(unit @ unit[q]), kind="stable") if i != q][:3]
        for rank, i in enumerate(order, 1):
            assert got[q, rank][0] == i and got[q, rank][1] == pytest.approx(unit[i] @ unit[q], abs=1e-12)
