"""Ranked lexical search: document FP-trees of restricted term vectors, searched by branch and bound for each item."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.common import save, words


class Item(NamedTuple):
    """One item: its terms' numbers, rarest first, and what each adds at most: weight x repeats in the item."""

    terms: np.ndarray
    weights: np.ndarray


def _restricted(shared):
    """doc_id, all terms counted, and the numbers and counts of those terms that the items have; texts without terms go."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            ids, sizes, terms, counts, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if w := words(text):
                    known = Counter(w)
                    found = [(number[t], c) for t, c in known.items() if t in number]
                    terms += [t for t, _ in found]
                    counts += [c for _, c in found]
                    ids.append(doc_id)
                    sizes.append(len(w))
                    ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, batch.schema.field("doc_id").type), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int32()))],
                names=["doc_id", "n", "terms", "counts"])

    return vectors


def _frequencies(size: int):
    """Of one task: documents that hold each term (by number), then all documents and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size + 2, np.int64)
        for batch in batches:
            held[:size] += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
            held[size:] += [batch.num_rows, batch.column("n").to_numpy().sum()]
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(held[some])], names=["place", "total"])

    return count


def scores(tf: np.ndarray, m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of columns: terms x columns counts, the columns' m. Grows with a count, falls with m: largest counts and the least m bound it."""
    return weights @ (1_000_000_000 * tf // np.maximum(1, 1000 * tf + 8 * m))


class Tree:
    """The FP-tree of a block of documents, restricted to one item's terms.

    A document's path names its terms among the item's, rarest first, so that documents with the same terms share a
    leaf and those with the same rare terms share their path's beginning. Paths are bit rows in sorted order; a node
    is a run of them that agree as far as its level, a level without any fork is left out. Each node has the
    largest count of each term and the least m below it.
    """

    def __init__(self, tf: np.ndarray, m: np.ndarray):
        has = tf > 0
        some = np.flatnonzero(has.any(axis=0))
        packed = np.packbits(has[:, some], axis=0)  # bytes of a path, first terms first
        order = np.lexsort(packed[::-1])
        packed, self.rows = packed[:, order], some[order]
        self.tf, self.m = tf[:, self.rows], m[self.rows]
        differ = np.diff(packed, axis=1) != 0
        forks = np.flatnonzero(differ.any(axis=0)) + 1
        byte = differ[:, forks - 1].argmax(axis=0)
        first = packed[byte, forks] ^ packed[byte, forks - 1]
        level = byte * 8 + 7 - np.floor(np.log2(np.maximum(1, first))).astype(int)  # first term in which a leaf leaves the one before
        self.starts = np.concatenate(([0], forks)) if len(self.rows) else np.empty(0, int)
        self.ends = np.append(self.starts[1:], len(self.rows))
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # of each: children's first and end, largest counts, least m
        if not len(self.rows):
            return
        most, least = np.maximum.reduceat(self.tf, self.starts, axis=1), np.minimum.reduceat(self.m, self.starts)
        self.levels.append((self.starts, self.ends, most, least))
        kept = np.concatenate(([-1], level))  # of each node at the present level: the term in which it leaves the one before
        for depth in np.unique(level)[::-1]:
            starts = np.flatnonzero(kept < depth)
            ends, kept = np.append(starts[1:], len(kept)), kept[starts]
            most, least = np.maximum.reduceat(most, starts, axis=1), np.minimum.reduceat(least, starts)
            self.levels.append((starts, ends, most, least))

    def search(self, weights: np.ndarray, ids: np.ndarray, best: Best) -> int:
        """Depth first, the highest bound first; a node below the k-th score so far is cut. Returns the documents scored."""
        if not self.levels:
            return 0
        seen, top = 0, len(self.levels) - 1
        stack = [(int(scores(self.levels[top][2], self.levels[top][3], weights)[0]), top, 0)]
        while stack:
            bound, level, node = stack.pop()
            if bound < best.least:
                continue
            a, z = self.levels[level][0][node], self.levels[level][1][node]
            while level and z - a == 1:  # no fork here
                level -= 1
                a, z = self.levels[level][0][a], self.levels[level][1][a]
            if not level:
                best.add(scores(self.tf[:, a:z], self.m[a:z], weights), ids[self.rows[a:z]])
                seen += z - a
                continue
            bounds = scores(self.levels[level - 1][2][:, a:z], self.levels[level - 1][3][a:z], weights)
            stack += sorted((b, level - 1, a + i) for i, b in enumerate(bounds.tolist()) if b >= best.least)
        return seen


class Best:
    """The k highest scores above 0 so far, equal ones by the smaller id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.least = k, np.empty(0, np.int64), np.empty(0, np.int64), 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        new = scores >= self.least
        scores, ids = np.concatenate((self.scores, scores[new])), np.concatenate((self.ids, ids[new]))
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = max(1, int(self.scores[-1]))


class Block:
    """Restricted vectors of some documents, by term."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, size: int):
        doc = np.repeat(np.arange(len(ids)), np.diff(ends))
        order = np.argsort(terms, kind="stable")
        self.ids, self.m, self.doc, self.counts = ids, m, doc[order], counts[order]
        self.at = np.searchsorted(terms[order], np.arange(size + 1))

    def search(self, item: Item, best: Best) -> int:
        """Returns the documents scored."""
        held = np.flatnonzero(self.at[item.terms] < self.at[item.terms + 1])
        tf = np.zeros((len(held), len(self.ids)), np.int64)
        for row, t in enumerate(item.terms[held]):
            some = slice(self.at[t], self.at[t + 1])
            tf[row, self.doc[some]] = self.counts[some]
        return Tree(tf, self.m).search(item.weights[held], self.ids, best) if len(held) else 0


_NULL_ID = np.iinfo(np.int64).max  # a null doc_id, behind the others


def _search(shared, k: int, rows: int, postings: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, size, docs, total = shared.value
        best, held, n_rows, n_postings = [Best(k) for _ in items], [], 0, 0

        def flush() -> None:
            ids = np.concatenate([b.column("doc_id").fill_null(_NULL_ID).to_numpy() for b in held])
            n = np.concatenate([b.column("n").to_numpy() for b in held])
            lengths = np.concatenate([b.column("terms").value_lengths().to_numpy() for b in held])
            flat = lambda name: np.concatenate([b.column(name).flatten().to_numpy() for b in held])
            block = Block(ids, 100 - 75 + 75 * n * docs // total, np.concatenate(([0], np.cumsum(lengths))), flat("terms"), flat("counts").astype(np.int64), size)
            for item, found in zip(items, best):
                block.search(Item(*item), found)
            held.clear()

        for batch in batches:
            held.append(batch)
            n_rows, n_postings = n_rows + batch.num_rows, n_postings + len(batch.column("terms").flatten())
            if n_rows >= rows or n_postings >= postings:
                flush()
                n_rows = n_postings = 0
        if held:
            flush()
        for i, found in enumerate(best):
            ids = pa.array(found.ids, mask=found.ids == _NULL_ID)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i), pa.int32()), ids, pa.array(found.scores)], names=["item", "doc_id", "score"])

    return search


def _items_of(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    total = benchmark.select(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // (4 * block_words)))  # a word and its gap have four characters or so
    return [benchmark.where(F.expr(f"pmod(xxhash64(item_id, text), {blocks}) = {i}")) for i in range(blocks)] if blocks > 1 else [benchmark]


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_rows: int = 8192, block_postings: int = 1_000_000,
                   block_words: int = 500_000) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item, scores in integers.

    One pass over the documents keeps their terms that items have (a written table), sums give the terms' frequencies
    over all documents. A task takes `block_rows` such vectors at a time (fewer beyond `block_postings` terms), builds for
    each item the FP-tree of its terms, and searches it with the k-th best of its earlier blocks as the limit; each task
    gives k rows an item and the best k of all tasks remain. No row, candidate or term is left out: a node is cut
    only where its bound is below k found documents. Items pass through the driver in blocks of some
    `block_words` words, and the documents are read once for each.

    A null or empty text, or one without terms, is no document of the collection, and no item that anything is found
    for. Repeated rows, of documents or items, stand for themselves; a null doc_id comes behind equal scores.
    Columns but doc_id, text and item_id are ignored. Without documents or items there are no rows.
    """
    spark, docs = docs.sparkSession, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = []
    for part in _items_of(items.select("item_id", "text").where("text is not null"), block_words):
        asked = [(r["item_id"], Counter(words(r["text"]))) for r in part.toLocalIterator()]
        number = {t: i for i, t in enumerate(sorted({t for _, terms in asked for t in terms}))}
        vectors = save(docs.where("text is not null").mapInArrow(_restricted(spark.sparkContext.broadcast(number)), (
            "doc_id long, n long, terms array<int>, counts array<int>")), "restricted")
        sums = vectors.select("n", "terms").mapInArrow(_frequencies(len(number)), "place int, total long").groupBy("place").agg(F.sum("total").alias("total"))
        held = np.zeros(len(number) + 2, np.int64)
        for r in sums.toLocalIterator():
            held[r["place"]] = r["total"]
        n, total = int(held[-2]), int(held[-1])
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in held[:-2]], np.int64)
        searched = []
        for _, terms in asked:
            at = np.array([number[t] for t in terms], np.int64)
            times = np.array(list(terms.values()), np.int64)
            order = np.lexsort((at, held[at])) if len(at) else at
            searched.append(Item(at[order], (weight[at] * times)[order] if len(at) else at))
        shared = spark.sparkContext.broadcast((list(map(tuple, searched)), len(number), n, total))
        found = vectors.mapInArrow(_search(shared, k, block_rows, block_postings), "item int, doc_id long, score long")
        whole = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
        named = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(asked)], "item int, item_id long")
        parts.append(found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))  # as many as a block has items
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
