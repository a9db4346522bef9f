"""Benchmark decontamination with one Aho-Corasick automaton over word-coded benchmark windows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import WORD_ANY_CASE, put_aside, save, words

RESULT = ("struct<n_words:bigint,runs:array<struct<first:bigint,last:bigint>>,items:array<string>,"
          "spans:array<struct<start:bigint,end:bigint>>>")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_TYPE = pa.struct([("n_words", pa.int64()), ("runs", _RUNS), ("items", pa.list_(pa.string())), ("spans", _SPANS)])


def windows(items: Iterable[tuple[str | None, str | None]], size: int) -> dict[tuple[bytes, ...], list[str]]:
    """Windows of `size` consecutive words of each text (a shorter text is one window) with the ids that have them."""
    found: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            found.setdefault(tuple(w[i : i + size]), set()).update([item] if item is not None else [])
    return {k: sorted(v) for k, v in found.items()}


class Scanner:
    """The automaton over word codes.

    A benchmark word is written as the digits of its number, each place with characters of its own, any
    other word as one character that no pattern has. So patterns only match at word borders, and a node
    has few children.
    """

    DIGITS = 64

    def __init__(self, found: dict[tuple[bytes, ...], list[str]]):
        import ahocorasick

        vocabulary = sorted({w for k in found for w in k})
        places = 1
        while self.DIGITS**places < len(vocabulary):
            places += 1
        self.code = {
            w: "".join(chr(1 + p * self.DIGITS + i // self.DIGITS**p % self.DIGITS) for p in range(places)) for i, w in enumerate(vocabulary)}
        self.automaton = ahocorasick.Automaton()
        for k, ids in found.items():
            self.automaton.add_word("".join(map(self.code.__getitem__, k)), (len(k), ids))
        if found:
            self.automaton.make_automaton()
        self.empty, self.places = not found, places

    def scan(self, text: str | None, runs: list, items: list) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Words, hit runs of words (first and last, joined with those given) and items of one text."""
        w = words(text)
        if self.empty or not w:
            return len(w), runs, items
        codes = list(map(self.code.get, w, repeat("\0")))
        ends = list(self.automaton.iter("".join(codes)))
        if not ends:
            return len(w), runs, items
        word_ends = np.cumsum([len(c) for c in codes]) - 1
        hits = [(int(np.searchsorted(word_ends, end)), n, ids) for end, (n, ids) in ends]
        joined: list[tuple[int, int]] = []
        for first, last in sorted([(last - n + 1, last) for last, n, _ in hits] + runs):
            if joined and first <= joined[-1][1] + 1:
                joined[-1] = (joined[-1][0], max(last, joined[-1][1]))
            else:
                joined.append((first, last))
        return len(w), joined, sorted({x for _, _, ids in hits for x in ids} | set(items))


def _char_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points of the original text that the runs of words cover."""
    at = [m.span() for m in re.finditer(WORD_ANY_CASE, text)]
    return [(at[a][0], at[b][1]) for a, b in runs]


def _scan_udf(shared):
    state: list[Scanner] = []  # built once in each Python worker

    @F.arrow_udf(RESULT)
    def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        if not state:
            state.append(Scanner(shared.value))
        for text, before in batches:
            rows = []
            for t, b in zip(text.to_pylist(), before.to_pylist()):
                b = b or {}
                old = [(r["first"], r["last"]) for r in b.get("runs") or []]
                n, runs, items = state[0].scan(t, old, b.get("items") or [])
                rows.append({
                    "n_words": n, "runs": [{"first": a, "last": z} for a, z in runs], "items": items,
                    "spans": [{"start": a, "end": z} for a, z in _char_spans(t, runs)] if runs else []})
            yield pa.array(rows, _TYPE)

    return scan


def find_leaks(docs: DataFrame, benchmark: DataFrame, size: int = 10, block_words: int = 2_000_000) -> DataFrame:
    """Adds `leak`: n_words, runs (first and last word hit), items (ids as strings) and spans (code points).

    A window is `size` consecutive words of a benchmark text; a text with fewer words is one window. A
    document word inside any occurrence of a window is hit. The automaton of `block_words` window words
    at most goes to the workers; a larger benchmark is cut into blocks by a hash of its texts and the
    documents are scanned once for each, so that its size is bounded whatever the benchmark's is.

    Null or empty text: no words, no hits. Benchmark rows without words match nothing; a null item_id
    hits words but is not listed. Repeated rows on either side: each document row has its own result.
    Empty tables give empty results or no hits. An existing column `leak` is replaced.
    """
    docs = docs.drop("leak")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    total = items.select(F.sum(F.regexp_count("text", F.lit(WORD_ANY_CASE))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total * size // block_words))
    spark, none = docs.sparkSession, F.lit(None).cast(RESULT)
    for i in range(blocks):
        part = items.where(F.expr(f"pmod(xxhash64(text), {blocks}) = {i}")) if blocks > 1 else items
        shared = spark.sparkContext.broadcast(windows(((r["item_id"], r["text"]) for r in part.toLocalIterator()), size))
        before = F.col("leak") if i else none
        docs = docs.withColumn("leak", _scan_udf(shared)(F.col("text"), before))
        if i < blocks - 1:
            docs = save(docs, "leaks")
    return docs


def summary(leaks: DataFrame) -> DataFrame:
    """One row per document: counts, a digest of the items, and whether it is contaminated."""
    n_hit = F.expr("aggregate(leak.runs, 0L, (s, r) -> s + r.last - r.first + 1)")
    return leaks.select(
        "doc_id", F.col("leak.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "leak.items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with their columns as they were (a column `leak`, in any case, included)."""
    held, aside = put_aside(docs, "leak")
    clean = find_leaks(held, benchmark, **options).where("size(leak.runs) = 0").drop("leak")
    return clean.withColumnsRenamed(aside).select(*[f"`{c}`" for c in docs.columns])
