"""Personal data: pattern detection, then removal of terms that give protected entities away by co-occurrence."""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.llm.common import WORD_ANY_CASE, free_name, save, words

#: The protected entities, in the order in which spans are listed; `term` marks what gives them away.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match starts where a run of digits does: from inside the run the same text follows.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = {c: None for c in map(ord, " ().+-")}
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def luhn(digits: str) -> bool:
    doubled = "0246813579"
    return sum(int(doubled[int(d)]) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def find_entities(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive. Leftmost matches that don't overlap in a kind."""
    found: list[tuple[str, int, int]] = []
    if not text:
        return found
    end = 0
    at = text.find("@")
    while at >= 0:
        if match := _DOMAIN.match(text, at):
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append(("email", start, end := match.end()))
        at = text.find("@", max(at + 1, end))
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0")[:3] or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if len(m[0]) >= 16 and 16 <= len(digits := m[0].translate(_NOT_DIGIT)) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(m[0].translate(_NOT_DIGIT)) <= 15]
    return found


def value_of(kind: str, found: str) -> str:
    """The entity behind a match: one address, card or number in its different spellings."""
    if kind == "email":
        return f"{kind} {found.encode().translate(_LOWER).decode()}"
    if kind == "ip":
        return f"{kind} {'.'.join(x.lstrip('0') or '0' for x in found.split('.'))}"
    return f"{kind} {found.translate(_NOT_DIGIT)}"


def places_outside(text: str, found: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the words outside all entities."""
    merged: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in found):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    places, reach = [], 0
    for m in re.finditer(WORD_ANY_CASE, text):
        while reach < len(merged) and merged[reach][1] <= m.start():
            reach += 1
        if reach == len(merged) or m.end() <= merged[reach][0]:
            places.append(m.span())
    return places


def _term(text: str, start: int, end: int) -> bytes:
    return words(text[start:end])[0]


def nearby(text: str, found: list[tuple[str, int, int]], window: int) -> list[tuple[str, bytes]]:
    """(entity, term) for each word within `window` words of an entity, outside all entities: once for each kind, and once for each value."""
    places = places_outside(text, found)
    starts = [a for a, _ in places]
    near: set[tuple[str, int]] = set()
    for kind, a, b in found:
        before, after = bisect.bisect_left(starts, a), bisect.bisect_left(starts, b)
        value = value_of(kind, text[a:b])
        near.update((e, i) for i in range(max(0, before - window), min(len(places), after + window)) for e in (kind, value))
    return [(e, _term(text, *places[i])) for e, i in near]


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@F.arrow_udf(T.ArrayType(_SPAN))
def _detect(text: pa.Array) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in find_entities(t)] for t in text.to_pylist()], _ARROW)


def _found(spans: list[dict]) -> list[tuple[str, int, int]]:
    return [(s["kind"], s["start"], s["end"]) for s in spans]


def _count_near(window: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, bytes]] = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([e for e, _ in counts], pa.string()), pa.array([w.decode("utf-8", "replace") for _, w in counts], pa.string()),
                pa.array(counts.values(), pa.int64())], names=["entity", "term", "near"])

        for batch in batches:
            for t, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update(nearby(t, _found(spans), window))
                if len(counts) > 100_000:  # bounded memory; the shuffle adds up
                    yield flush()
                    counts.clear()
        yield flush()

    return count


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        terms = [w.decode("utf-8", "replace") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "n"])

    for batch in batches:
        for t in batch.column(0).to_pylist():
            counts.update(words(t))
            if len(counts) > 200_000:  # bounded memory; the shuffle adds up
                yield flush()
                counts.clear()
    yield flush()


def revealing_terms(detected: DataFrame, hit: str, window: int = 6, threshold: float = 0.9, error: float = 0.05) -> DataFrame:
    """(entity, term, near, total, disclosure) of the terms that give a protected entity away.

    `detected` has texts and, in the column `hit`, their pattern spans. An entity is a kind as a whole, or one
    value of it: an address, a card, a number. p(entity | term) is the share of a term's occurrences in the
    corpus that stand near the entity, p(entity) the share of all words that do. Disclosure is their pointwise
    mutual information over the entity's own information, -log p(entity): 1 if the term always stands near it,
    0 if it says nothing. The share is taken at its lower 95 % bound (Wilson). A pair must also be significant:
    the chance of so many occurrences near the entity, if the term stood anywhere, is below `error` over all
    pairs of terms and entities (Chernoff's bound of the binomial tail, times their number). So few occurrences
    are enough beside a rare entity, and one beside another by chance is not.
    """
    near = detected.where(F.size(hit) > 0).select("text", hit).mapInArrow(_count_near(window), "entity string, term string, near bigint")
    near = save(near.groupBy("entity", "term").agg(F.sum("near").alias("near")), "near")
    counted = detected.select("text").mapInArrow(_count_words, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("total"))
    counted = save(counted, "words")
    whole = counted.agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("n")).first()
    all_words = float(whole["n"] or 1)
    by_entity = save(near.groupBy("entity").agg((F.sum("near") / all_words).alias("chance")), "entities")
    pairs = float(max(1, whole["terms"]) * max(1, by_entity.count()))
    z = 1.96
    share = F.least(F.col("near") / F.col("total"), F.lit(1.0))
    low = (share + z * z / (2 * F.col("total")) - z * F.sqrt(share * (1 - share) / F.col("total") + z * z / (4 * F.col("total") ** 2))) / (
        1 + z * z / F.col("total"))
    # Words near the entity are these at least, so this is the most that can come out: little is left for the second join.
    most = 1 - F.log(low) / F.log(F.col("near") / all_words)
    both = near.join(counted, "term").where(most >= threshold).join(by_entity, "entity")
    disclosure = 1 - F.log(low) / F.log("chance")
    other = F.when(share < 1, (F.col("total") - F.col("near")) * F.log((1 - share) / (1 - F.col("chance")))).otherwise(0.0)
    rare = F.col("near") * F.log(share / F.col("chance")) + other >= F.lit(math.log(pairs / error))
    return both.withColumn("disclosure", disclosure).where((F.col("disclosure") >= threshold) & rare).drop("chance")


def _marks(terms: DataFrame) -> np.ndarray:
    """Bits at the CRC-32 of each term, at most 16 MB: passes each of them and few other words."""
    size = 1 << min(27, max(16, (64 * terms.count()).bit_length()))
    at = terms.select(F.crc32("term").bitwiseAND(size - 1).alias("at")).distinct().toArrow()["at"].to_numpy()
    bits = np.zeros(size // 8, np.uint8)
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits


def _candidates(bits: np.ndarray):
    """(n, term, places) of the words outside entities that may be revealing terms."""
    table = bits.tobytes()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = len(table) * 8 - 1
        places_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows, terms, places = [], [], []
            for n, t, spans in zip(*(c.to_pylist() for c in batch.columns)):
                may = {w for w in set(words(t)) if table[(at := zlib.crc32(w) & last) >> 3] >> (at & 7) & 1}
                if not may:
                    continue
                met: dict[bytes, list] = {}
                for a, b in places_outside(t, _found(spans)):
                    if (w := _term(t, a, b)) in may:
                        met.setdefault(w, []).append({"start": a, "end": b})
                rows += [n] * len(met)
                terms += [w.decode("utf-8", "replace") for w in met]
                places += met.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(terms, pa.string()), pa.array(places, places_type)], names=["n", "term", "places"])

    return find


def find_private(docs: DataFrame, window: int = 6, threshold: float = 0.9, error: float = 0.05,
                 columns: list[str] | None = None) -> DataFrame:
    """Adds `private`: array of (kind, start, end) in code points, by kind as in KINDS and then terms, then start.

    Emails, addresses, cards and phone numbers are found by pattern in whole texts. Terms whose
    disclosure of a kind or of one value (see revealing_terms; counted over the whole corpus, near meaning
    within `window` words) reaches the threshold are private too, wherever in the corpus they stand outside
    pattern spans.

    Texts, spans and row numbers are written first. A second pass finds the terms' occurrences in all
    texts: a filter of bits leaves few other words, the join to the table of terms decides, and
    occurrences go back to their rows by row number.

    Null or empty text: no spans. Repeated rows: each is searched and counted. Empty table: no rows. A
    column called private is replaced; all others stay, or only `columns`.
    """
    docs = docs.drop("private")
    carried = docs.columns if columns is None else columns
    row, hit = free_name(docs, "row"), free_name(docs, "hit")
    kept = carried if "text" in carried else [*carried, "text"]
    detected = save(
        docs.withColumn(row, F.monotonically_increasing_id()).withColumn(hit, _detect("text")).select(
            *[f"`{c}`" for c in kept], row, hit), "detected")
    terms = save(revealing_terms(detected, hit, window, threshold, error).select("term").distinct(), "terms")
    places = detected.where("text is not null").select(row, "text", hit).mapInArrow(
        _candidates(_marks(terms)), "n bigint, term string, places array<struct<start:bigint,end:bigint>>")
    places = places.join(terms, "term").select("n", F.explode("places").alias("x")).groupBy("n").agg(F.array_sort(F.collect_list(
        F.struct(F.lit(TERM).alias("kind"), "x.start", "x.end"))).alias("terms"))
    joined = detected.join(places, detected[row] == places["n"], "left")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return joined.select(
        *[detected[f"`{c}`"] for c in carried], F.concat(F.col(hit), F.coalesce("terms", none)).alias("private"))


def redact(text: Column, private: Column) -> Column:
    """The text with each private span generalised to its kind in angle brackets; overlapping spans become one of the first kind."""

    @F.arrow_udf(T.StringType())
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts, spans):
            t, parts, end = t.as_py(), [], 0
            for a, b, kind in sorted((x["start"], x["end"], x["kind"]) for x in s.as_py() or ()):
                if a >= end:
                    parts += [t[end:a], f"<{kind}>"]
                end = max(end, b)
            out.append(None if t is None else "".join(parts) + t[end:])
        return pa.array(out, pa.string())

    return cut(text, private)


def summary(found: DataFrame) -> DataFrame:
    """One row per document: counts by kind, a digest of the pattern spans, and all spans."""
    listed = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("private", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(listed(F.filter("private", lambda x: x["kind"] != TERM)), 256).alias("base_sha256"),
        listed(F.col("private")).alias("spans"))
