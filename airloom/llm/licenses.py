"""License scans: ordered signature rules behind a keyword gate, overlaps resolved by priority and containment."""

from __future__ import annotations

import functools
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import WORD_ANY_CASE, free_name, let, lower_ascii, scanned

# The phrases that every scan reports, and the label of each.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# License names as words: label, keyword that any mention contains, name as a pattern over words. A pattern is
# written with one space between words; ` ?` groups hold a leading space.
_VERSION = "(?: version| v)?"
FAMILIES = [
    ("mit", "mit", "(?:expat|mit)"), ("mit-0", "mit", "mit (?:0|no attribution)"), ("isc", "isc", "isc"),
    ("x11", "x11", "(?:mit )?x11"), ("zlib", "zlib", "zlib(?: libpng)?"), ("beerware", "beer", "beer ?ware"),
    ("wtfpl", "wtfpl", "wtfpl"), ("unlicense", "unlicense", "(?:the )?unlicense"), ("bsl-1.0", "boost", "boost(?: software)?(?: 1 0)?"),
    ("postgresql", "postgresql", "postgresql"), ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?"),
    ("artistic", "artistic", f"(?:perl )?artistic{_VERSION}(?: [12] 0)?"), ("zpl", "zope", f"zope public{_VERSION}(?: [0-9] [0-9])?"),
    ("python-2.0", "python", "python(?: software foundation)?(?: 2 0)?"), ("php", "php", f"php{_VERSION}(?: 3 0[01]?)?"),
    ("ruby", "ruby", "ruby"), ("openssl", "openssl", "openssl"), ("ftl", "freetype", "freetype(?: project)?"),
    ("ofl-1.1", "ofl", "(?:sil )?ofl(?: 1 1)?"), ("ofl-1.1", "sil", f"sil open font{_VERSION}(?: 1 1)?"),
    ("apache", "apache", "apache(?: software)?"), ("bsd", "bsd", "(?:new |simplified |modified |revised )?bsd(?: style)?"),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd|bsd zero clause)"), ("gpl", "gpl", "(?:gnu )?gpl"), ("lgpl", "lgpl", "(?:gnu )?lgpl"),
    ("agpl", "agpl", "(?:gnu )?agpl"), ("gpl", "general", "(?:gnu )?general public"), ("lgpl", "lesser", "(?:gnu )?lesser general public"),
    ("lgpl", "library", "(?:gnu )?library general public"), ("agpl", "affero", "(?:gnu )?affero general public"),
    ("gfdl", "gfdl", "(?:gnu )?gfdl"), ("gfdl", "documentation", "(?:gnu )?free documentation"), ("mpl", "mpl", "mpl"),
    ("mpl", "mozilla", "mozilla public"), ("epl", "eclipse", "eclipse public"), ("edl", "eclipse", "eclipse distribution"),
    ("cddl", "cddl", "cddl"), ("cddl", "development", "common development and distribution"), ("cpl", "common", "common public"),
    ("eupl", "eupl", "eupl"), ("eupl", "european", "european union public"), ("ms-pl", "microsoft", "microsoft public"),
    ("ms-rl", "microsoft", "microsoft reciprocal"), ("osl", "osl", "osl"), ("osl", "open", "open software"), ("qpl", "public", "q public"),
    ("afl", "academic", "academic free"), ("odbl", "database", "open(?: data commons)? database"), ("cecill", "cecill", "cecill"),
    ("odc-by", "attribution", "open data commons attribution"), ("sspl", "side", "server side public"), ("busl", "business", "business source"),
    ("elastic", "elastic", "elastic"), ("llama", "llama", "llama(?: [23])? community"), ("openrail", "openrail", "(?:big ?science )?openrail(?: m)?"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"), ("cc", "creative", "creative commons"),
]
#: How a name is mentioned: pattern with {0} for the name, keyword of the form, priority, confidence.
FORMS = [
    ("spdx license identifier {0}", "spdx", 90, 0.99),
    ("(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?{0}(?: licen[cs]e)?", "under", 70, 0.95),
    ("(?:the )?{0} licen[cs]e", "licen", 50, 0.9),
    ("subject to (?:the )?(?:terms of )?(?:the )?{0}(?: licen[cs]e)?", "subject", 60, 0.9),
]
#: Versions of families that have them: label suffix, pattern.
VERSIONED = {
    "gpl": ["1", "2", "3"], "lgpl": ["2", "2.1", "3"], "agpl": ["1", "3"], "gfdl": ["1.1", "1.2", "1.3"], "mpl": ["1.0", "1.1", "2.0"],
    "apache": ["1.0", "1.1", "2.0"], "epl": ["1.0", "2.0"], "cddl": ["1.0", "1.1"], "eupl": ["1.0", "1.1", "1.2"],
    "osl": ["1.0", "2.0", "2.1", "3.0"], "afl": ["1.1", "1.2", "2.0", "2.1", "3.0"], "cecill": ["1.0", "2.0", "2.1"], "qpl": ["1.0"],
}
#: Phrases that are no name in a form: label, keyword, pattern, priority, confidence.
SINGLE = [
    ("cc0", "public", "(?:dedicated to|released into|in) the public domain", 60, 0.8),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 95, 0.99),
    ("mit", "merchantability", "permission is hereby granted free of charge to any person obtaining a copy", 85, 0.95),
    ("mit", "charge", "permission is hereby granted free of charge to any person obtaining a copy", 85, 0.95),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 85, 0.95),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 85, 0.9),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software", 86, 0.9),
    ("proprietary", "proprietary", "proprietary and confidential", 55, 0.8), ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", 20, 0.4),
    ("proprietary", "permission", "(?:without|except with) (?:the )?(?:express |prior )?(?:written )?permission of", 40, 0.5),
]
RULE_TYPE = "struct<label:string,keyword:string,second:string,pattern:string,priority:int,confidence:double,number:int>"
_PLACES = "array<struct<label:string,first:bigint,last:bigint,priority:int,confidence:double,number:int>>"


def signature_rules() -> list[tuple[str, str, str, str, int, float]]:
    """All rules in order: (label, two keywords that any match contains, pattern over words, priority, confidence)."""
    rules = [(label, key, key, pattern, priority, sure) for label, key, pattern, priority, sure in SINGLE]
    for (label, key, name), (form, second, priority, sure) in product(FAMILIES, FORMS):
        rules.append((label, key, second, form.format(name), priority, sure))
        if label in VERSIONED and second in ("under", "licen"):
            licence = "(?: licen[cs]e)?" if second == "under" else " licen[cs]e"
            for v in VERSIONED[label]:
                number = v.removesuffix(".0").replace(".", " ") + ("" if "." in v.removesuffix(".0") else "(?: 0)?")
                numbered = f"{name}{licence}{_VERSION} v?{number}(?: only| or later| or any later version)?"
                rules.append((f"{label}-{v}", key, second, form.partition("{0}")[0] + numbered, priority + 5, round(sure + 0.04, 2)))
    parts = [("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nc", "attribution non ?commercial"),
             ("by-nd", "attribution no ?deriv(?:ative)?s"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
             ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s")]
    for (short, long), v in product(parts, ("", "1.0", "2.0", "2.5", "3.0", "4.0")):
        number, more = (f" {v.replace('.', ' ')}", f"-{v}") if v else ("", "")
        priority = 60 + len(short) + 5 * bool(v)
        rules.append((f"cc-{short}{more}", "cc", "by", f"cc {short.replace('-', ' ')}{number}", priority, 0.95))
        rules.append((f"cc-{short}{more}", "creative", "commons", f"creative commons {long}{number}", priority, 0.95))
    return list(dict.fromkeys(rules))


def padded(pattern: str) -> str:
    """A pattern over words as one over text in which every word has a space on both sides."""
    return " " + pattern.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?") + " "


def padded_words(text: Column) -> Column:
    """` w0  w1  w2 `: the lower-cased words, each between two spaces; empty without words."""
    joined = F.trim(F.regexp_replace(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "  "))
    return F.when(joined != "", F.concat(F.lit(" "), joined, F.lit(" "))).otherwise("")


def _places(norm: Column, pattern: Column) -> Column:
    """array<struct<first, last>>: words that the matches of a pattern cover."""
    pieces, matches = F.split(norm, pattern, -1), F.regexp_extract_all(norm, pattern, F.lit(0))
    spaces = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    steps = let(matches, lambda m: F.when(F.size(m) == 0, F.array().cast("array<struct<piece:string,match:string>>")).otherwise(
        F.arrays_zip(F.slice(pieces, 1, F.size(m)).alias("piece"), m.alias("match"))))

    def step(before: Column, x: Column) -> tuple[Column, Column]:  # how many spaces stand before
        first = before + spaces(x["piece"])
        after = first + spaces(x["match"])
        return after, F.struct(F.floor(first / 2).cast("bigint").alias("first"), (F.floor(after / 2) - 1).cast("bigint").alias("last"))

    return scanned(steps, F.lit(0), step, "struct<first:bigint,last:bigint>")


def _resolved(found: Column) -> Column:
    """Of overlapping detections the one of highest priority stays (then the longer, earlier, first rule)."""
    by_place = F.array_sort(found, lambda a, b: F.when(a["first"] != b["first"], F.sign(a["first"] - b["first"]).cast("int")).otherwise(
        (a["number"] - b["number"])))
    none = F.array().cast(_PLACES)

    def runs(ordered: Column) -> Column:  # detections that overlap, one array for each run
        apart = scanned(ordered, F.lit(-1).cast("bigint"), lambda reach, x: (F.greatest(reach, x["last"]), x["first"] > reach), "boolean")
        starts = let(apart, lambda a: F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: F.get(a, i)))
        cut = lambda s: F.transform(s, lambda at, j: F.slice(
            ordered, at + 1, F.coalesce(F.get(s, j + 1), F.size(ordered)) - at))
        return F.when(F.size(ordered) == 0, F.array().cast(f"array<{_PLACES}>")).otherwise(let(starts, cut))

    width = lambda x: x["last"] - x["first"]
    ahead = lambda a, b: (
        F.when(a["priority"] != b["priority"], b["priority"] - a["priority"])
        .when(width(a) != width(b), F.sign(width(b) - width(a)).cast("int"))
        .when(a["first"] != b["first"], F.sign(a["first"] - b["first"]).cast("int")).otherwise(a["number"] - b["number"]))
    chosen = lambda run: F.aggregate(
        F.array_sort(run, ahead), none,
        lambda kept, x: F.when(
            F.exists(kept, lambda k: (k["first"] <= x["last"]) & (k["last"] >= x["first"])), kept).otherwise(F.concat(kept, F.array(x))))
    return F.flatten(F.transform(let(by_place, runs), chosen))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Adds `license`: n_words, base (label, first and last word of each place of a phrase), found (the same, priority, confidence, rule number).

    Words are lower-cased runs of letters and digits; places count words from 0. `base` has all places
    of the fixed phrases. `found` has the detections of the signature rules that stay: of detections
    that overlap or contain one another, the one of highest priority (then the longer, the earlier, the
    first rule). A rule runs only on documents that contain both of its keywords, and a document without
    any rule's keywords is not searched at all. Everything runs row by row, without shuffles, over
    whole texts.

    Null or empty text: no words, nothing found. Repeated rows: each has its own result. Empty table: no
    rows. An existing column `license` is replaced; all others stay.
    """
    docs = docs.drop("license")
    names = [f.split(":")[0] for f in RULE_TYPE[7:-1].split(",")]
    rules = [(label, key, second, padded(pattern), priority, sure, i)
             for i, (label, key, second, pattern, priority, sure) in enumerate(signature_rules())]
    table = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rules])
    phrases = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(padded(p)).alias("pattern")) for p, label in PHRASES.items()])
    keys = sorted({k for r in rules for k in r[1:3]} | {w for p in PHRASES for w in p.split()})
    has = lambda found, *ws: F.arrays_overlap(found, F.array(*map(F.lit, ws))) if len(ws) == 1 else F.size(
        F.array_intersect(found, F.array(*map(F.lit, ws)))) == len(ws)
    seen = let(lower_ascii(F.col("text")), lambda t: F.filter(F.array(*map(F.lit, keys)), lambda k: F.contains(t, k)))
    gate = lambda found: F.exists(
        F.array(*[F.array(*map(F.lit, pair)) for pair in sorted({r[1:3] for r in rules})]),
        lambda pair: F.size(F.array_except(pair, found)) == 0)
    wanted = lambda found: F.filter(
        table, lambda r: F.array_contains(found, r["keyword"]) & F.array_contains(found, r["second"]))
    detections = lambda norm, found: F.flatten(F.transform(wanted(found), lambda r: F.transform(
        _places(norm, r["pattern"]), lambda x: F.struct(
            r["label"].alias("label"), x["first"].alias("first"), x["last"].alias("last"),
            r["priority"].alias("priority"), r["confidence"].alias("confidence"), r["number"].alias("number")))))
    based = lambda norm: F.flatten(F.transform(phrases, lambda p: F.transform(
        _places(norm, p["pattern"]), lambda x: F.struct(p["label"].alias("label"), x["first"].alias("first"), x["last"].alias("last")))))
    base_gate = lambda found: functools.reduce(
        lambda a, b: a | b, [has(found, *p.split()) for p in PHRASES])
    found, norm = free_name(docs, "seen"), free_name(docs, "norm")
    gated = docs.withColumn(found, F.coalesce(seen, F.array().cast("array<string>")))
    gated = gated.withColumn(norm, F.when(gate(F.col(found)) | base_gate(F.col(found)), padded_words(F.col("text"))))
    words = F.coalesce(F.regexp_count("text", F.lit(WORD_ANY_CASE)), F.lit(0)).cast("bigint")
    base = F.when(F.col(norm).isNotNull(), based(F.col(norm)))
    rest = F.when(F.col(norm).isNotNull(), let(detections(F.col(norm), F.col(found)), _resolved))
    return gated.withColumn("license", F.struct(
        words.alias("n_words"), F.coalesce(base, F.array().cast("array<struct<label:string,first:bigint,last:bigint>>")).alias("base"),
        F.filter(F.coalesce(rest, F.array().cast(_PLACES)), lambda x: x["label"].isNotNull()).alias("found"))).drop(found, norm)


def summary(scanned: DataFrame) -> DataFrame:
    """One row per document: places of the phrases, labels, and the confidence of the surest detection (0 without any)."""
    base, found = F.col("license.base"), F.col("license.found")
    labels = lambda a: F.array_sort(F.array_distinct(a))
    return scanned.select(
        "doc_id", F.col("license.n_words").alias("n_words"), F.size(base).cast("bigint").alias("n_base"),
        F.array_min(base["first"]).alias("first_word"), F.array_max(base["first"]).alias("last_word"),
        F.array_join(labels(base["label"]), ",").alias("base_labels"),
        F.array_join(labels(F.concat(base["label"], found["label"])), ",").alias("labels"),
        F.greatest(
            F.coalesce(F.array_max(found["confidence"]), F.lit(0.0)), F.when(F.size(base) > 0, 0.5).otherwise(0.0)).alias("score"))
