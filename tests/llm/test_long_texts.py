"""Texts with very many matches or quoted lines, and quotation links of random mails against a plain search."""

import random
import re
from collections import defaultdict

from llm_fixtures import make  # noqa: F401
from pyspark.sql import functions as F

from airloom.llm import common, licenses, quotes, urls

MARK, SAYS = re.compile(r"[ \t]*(?:>[ \t]?)+"), re.compile(r"(?:wrote|said) ?:[ \t]*$", re.I)


def plain_lines(text):
    out = []
    for line in re.split("\r?\n", text):
        mark = (MARK.match(line) or [""])[0]
        out.append((mark.count(">"), line[len(mark):]))
    return out


def plain_passages(lines):
    out, open_, at = [], [], 0
    for depth, body in [*lines, (0, "")]:
        depth = depth if body.strip(" \t\r") else 0
        if depth != at and open_:
            out.append((at, open_))
            open_ = []
        at = depth
        if depth:
            open_ = [*open_, body]
    return out


def normal(text):
    return " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))


def plain_pieces(lines):
    return {("piece", p) for p in [normal(" ".join(lines)), *map(normal, lines)] if p}


def plain_runs(words, n):
    return {("run", " ".join(words[i : i + n])) for i in range(len(words) - n + 1)} if n else set()


def plain_links(mails):
    """{(conversation, turn): (own text, passages, reply, thread)} of distinct turns."""
    own, asked = {}, {}
    for conv, turn, text in mails:
        lines = plain_lines(text)
        stays = [b for (d, b), after in zip(lines, [*lines[1:], (0, "")]) if not d and not (SAYS.search(b) and after[0])]
        own[conv, turn] = "\n".join(stays).strip("\n") if any(d for d, _ in lines) else text
        asked[conv, turn] = [(d, plain_pieces(p), normal(" ".join(p)).split()) for d, p in plain_passages(lines)]
    first = {}
    for (conv, turn), text in sorted(own.items()):
        lines, words = re.split("\r?\n", text), normal(text).split()
        for key in plain_pieces(lines).union(*[plain_runs(words, n) for n in range(1, 6)]):
            first.setdefault((conv, key), turn)
    reply = {}
    for (conv, turn), passages in asked.items():
        score = defaultdict(int)
        for depth, pieces, words in passages:
            for kind, key in pieces | plain_runs(words, min(5, len(words))):
                said = first.get((conv, (kind, key)), turn)
                if said < turn:
                    score[depth, said] += len(key) * (5 if kind == "piece" else 1)
        if score:
            reply[conv, turn] = min((d, -size, said) for (d, said), size in score.items())[2]
    out = {}
    for conv, turn in own:
        root = turn
        while (conv, root) in reply:
            root = reply[conv, root]
        out[conv, turn] = (own[conv, turn], len(asked[conv, turn]), reply.get((conv, turn)), root)
    return out


def random_mails(seed):
    rng, mails = random.Random(seed), []
    say = lambda: " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 9)))
    for conv in range(6):
        texts = []
        for turn in range(12):
            lines = [say() for _ in range(rng.randrange(1, 4))]
            if texts and rng.random() < 0.8:
                said = rng.choice(texts).split("\n")
                start = rng.randrange(len(said))
                cited = said[start : start + rng.randrange(1, 6)]
                if rng.random() < 0.3:
                    cited = " ".join(cited).split("w1", 1)
                quoted = [rng.choice(["> ", ">", " > "]) + c for c in cited]
                if rng.random() < 0.3:
                    quoted.insert(rng.randrange(len(quoted) + 1), rng.choice(["> ", "", "mine", ">> deep w1 w2"]))
                lines = [*([] if rng.random() < 0.5 else ["Someone wrote:"]), *quoted, *lines]
            texts.append("\n".join(lines))
            mails.append((conv, turn, texts[-1]))
    return mails


def test_links_of_random_mails_are_those_of_a_plain_search(spark):
    mails = random_mails(4)
    got = quotes.link_quotes(spark.createDataFrame(mails, "conv_id long, turn long, text string")).collect()
    want = plain_links(mails)
    assert {(r["conv_id"], r["turn"]): (r["own_text"], r["n_quotes"], r["reply_to"], r["thread"]) for r in got} == want
    assert sum(w[2] is not None for w in want.values()) > 20
    for conv in range(6):
        order = sorted(r["turn"] for r in got if r["conv_id"] == conv)
        placed = [r["turn"] for r in sorted((r for r in got if r["conv_id"] == conv), key=lambda r: r["position"])]
        assert placed == sorted(order, key=lambda t: (want[conv, t][3], t))


def test_passages_of_odd_lines(spark):
    texts = ["> a\x01b\x02\n>\x01\n> c", "> \n>\n> x", ">> a\n> b\n\n> c\nd\n>> e", "", "> one\r\n> two\r\nthree", "no\n> yes", ">\x010\x02x\n>>\x02\x01"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r["i"]: r["p"] for r in rows.select("i", quotes._passages(quotes._lines(F.col("text"))).alias("p")).collect()}
    for i, text in enumerate(texts):
        want = [(d, [b.translate({1: " ", 2: " "}) for b in p]) for d, p in plain_passages(plain_lines(text))]
        assert [(p["depth"], p["lines"]) for p in got[i]] == want, text


def test_very_many_quoted_lines(spark):
    said = "\n".join(f"line {i} of a long mail" for i in range(8_000))
    mails = [(1, 0, said), (1, 1, "\n".join(f"> {x}" for x in said.split("\n")) + "\nfine"), (1, 2, "> fine\nindeed")]
    rows = {r["turn"]: r for r in quotes.link_quotes(spark.createDataFrame(mails, "conv_id long, turn long, text string")).collect()}
    assert [rows[t]["reply_to"] for t in range(3)] == [None, 0, 1] and rows[1]["own_text"] == "fine" and rows[1]["n_quotes"] == 1


def test_very_many_places(make):
    n = 20_000
    row = licenses.scan_licenses(make([(1, "cc by and more prose " * n)])).first()["license"]
    assert row["n_words"] == 5 * n and [b["first"] for b in row["base"]] == list(range(0, 5 * n, 5))
    assert [(x["first"], x["last"], x["label"]) for x in row["found"]] == [(i, i + 1, "cc-by") for i in range(0, 5 * n, 5)]


def test_running_values(spark):
    sizes = [0, 1, common.CHUNK - 1, common.CHUNK, common.CHUNK + 1, 3 * common.CHUNK]
    rows = spark.createDataFrame([(n, list(range(n))) for n in sizes], "n int, xs array<int>")
    total = common.scanned(F.col("xs"), F.lit(0), lambda s, x: (s + x, s + x), "int")
    for r in rows.select("n", total.alias("sums")).collect():
        assert r["sums"] == [i * (i + 1) // 2 for i in range(r["n"])]
    assert spark.createDataFrame([(None,)], "xs array<int>").select(total.alias("t")).first()["t"] is None


def test_rule_paths_of_many_lengths(spark):
    n = urls.LENGTHS + 50
    rules = [("a.com", "/" + "x" * i, "block" if i % 2 else "allow") for i in range(n)] + [("b.org", "", "block")]
    pages = [(i, f"http://w.a.com/{'x' * i}{'y' * (i % 3)}?q") for i in range(0, n + 20, 7)] + [(9000, "http://b.org"), (9001, None), (9002, "http://c.org/x")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge_urls(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, urls.RULES)).collect()}
    for i, _ in pages:
        k = min(i, n - 1)
        want = {9000: ("b.org", "block"), 9001: (None, "allow"), 9002: (None, "allow")}.get(
            i, ("a.com/" + "x" * k, "block" if k % 2 else "allow"))
        assert got[i] == want, i
