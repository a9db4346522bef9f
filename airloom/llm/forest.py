"""Approximate nearest neighbours by cosine with a forest of sorted hash strings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.common import save

TREES, BITS = 128, 20


def planes(dim: int, trees: int = TREES, bits: int = BITS, seed: int = 3) -> np.ndarray:
    """Random hyperplanes: trees x dim x bits."""
    return np.random.default_rng(seed + dim).standard_normal((trees, dim, bits)).astype(np.float32)


def hash_strings(vectors: np.ndarray, plane: np.ndarray) -> np.ndarray:
    """The hash string of each vector in one tree, as an integer whose first bit is the highest."""
    bits = plane.shape[1]
    return (vectors.astype(np.float32) @ plane > 0) @ (1 << np.arange(bits - 1, -1, -1))


class Forest:
    """For each tree the rows in the order of their hash strings; a prefix is a slice of that array."""

    def __init__(self, vectors: np.ndarray, plane: np.ndarray):
        self.vectors, self.norms, self.planes = vectors, np.sqrt((vectors * vectors).sum(axis=1)), plane
        unit = vectors / self.norms[:, None]
        self.order, self.sorted = [], []
        for p in plane:
            strings = hash_strings(unit, p)
            self.order.append(np.argsort(strings, kind="stable"))
            self.sorted.append(strings[self.order[-1]])

    def descend(self, queries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Slices of all trees for each query.

        Every tree is descended to the longest prefixes; then all trees ascend together, bit by bit, until
        their slices hold `wanted` rows, repeats counted, or the prefix is empty and holds all rows.
        """
        trees, bits, n = len(self.planes), self.planes.shape[2], len(self.vectors)
        norms = np.sqrt((queries * queries).sum(axis=1))
        strings = np.stack([hash_strings(queries / norms[:, None], p) for p in self.planes])
        low, high = np.zeros((trees, len(queries)), np.int64), np.full((trees, len(queries)), n)
        open_ = np.arange(len(queries))
        for cut in range(bits):
            a, b = np.empty((trees, len(open_)), np.int64), np.empty((trees, len(open_)), np.int64)
            for t in range(trees):
                prefix = strings[t, open_] >> cut
                a[t] = np.searchsorted(self.sorted[t], prefix << cut)
                b[t] = np.searchsorted(self.sorted[t], (prefix + 1) << cut)
            low[:, open_], high[:, open_] = a, b
            open_ = open_[(b - a).sum(axis=0) < wanted]
            if not len(open_):
                break
        low[:, open_], high[:, open_] = 0, n  # the empty prefix
        return low, high

    def search(self, query: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows in the slices and their exact cosine with the query."""
        mask = np.zeros(len(self.vectors), bool)
        for t, (a, b) in enumerate(zip(low, high)):
            mask[self.order[t][a:b]] = True
            if b - a == len(mask):
                break
        rows = np.flatnonzero(mask)
        return rows, (self.vectors[rows] @ query) / (self.norms[rows] * np.sqrt(query @ query))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors by row, each times the power of two that brings its largest component near 1: no square overflows or
    vanishes, and the cosine stays the same to the last bit."""
    flat = column.combine_chunks()
    vectors = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, initial=0))[1][:, None])


_FOUND = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search_shard(k: int, share: float, least: int, trees: int, bits: int):
    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(rows) or not len(queries):
            return _FOUND.empty_table()
        vectors, asked = _matrix(rows["embedding"]), _matrix(queries["embedding"])
        ids, own, keys = (c.to_numpy() for c in (rows["vec_id"], queries["vec_id"], queries["key"]))
        forest = Forest(vectors, planes(vectors.shape[1], trees, bits))
        low, high = forest.descend(asked, max(least, int(share * len(vectors))))
        out = []
        for q in range(len(asked)):
            found, score = forest.search(asked[q], low[:, q], high[:, q])
            other = ids[found] != own[q]
            found, score = found[other], score[other]
            if len(found) > k:  # all that tie with the k-th, then by id
                pick = score >= np.partition(score, -k)[-k]
                found, score = found[pick], score[pick]
            best = np.lexsort((ids[found], -score))[:k]
            out.append((np.full(len(best), own[q]), np.full(len(best), keys[q]), ids[found[best]], score[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=_FOUND)

    return search


def usable(vector: Column) -> Column:
    """Not null, not all zero, every component a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, share: float = 0.4, least: int = 2048, rows_per_shard: int = 8192,
            queries_per_block: int = 4096, trees: int = TREES, bits: int = BITS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k rows of largest cosine that the forest finds.

    All rows are dealt over shards by a hash of their id. Each shard keeps, for every tree, its rows
    sorted by hash string; a query goes to every shard, in blocks, descends to its longest prefixes in
    all trees, and the trees ascend together until they hold `share` of the shard's rows (repeats counted;
    `least` at least). Those rows are compared exactly, in double precision, on the original vectors; the
    shards' best meet in one ranking by score, then smaller vec_id. Candidates are every row with another vec_id.

    Equal vectors: only their k + 1 smallest ids can be among anyone's k nearest, so the others are left
    out of the index without loss. Vectors that are null, all zero or hold null or non-finite components, and
    rows without an id, take no part on either side. Vectors of different lengths aren't compared. Repeated
    rows (same id and vector) count once. Fewer candidates than k: all of them. Empty tables: no rows.
    Other columns are ignored.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(
            "vec_id is not null").where(usable(F.col("embedding"))).distinct()

    copies = Window.partitionBy("embedding").orderBy("vec_id")
    rows = save(clean(vectors).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "vectors")
    asked = save(clean(queries).withColumn("key", F.xxhash64("embedding")), "queries")
    shards, blocks = -(-rows.count() // rows_per_shard), -(-asked.count() // queries_per_block)
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(0, n - 1))))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n)))
    dim = F.size("embedding").alias("dim")
    rows = rows.select("vec_id", "embedding", dim, dealt(shards).cast("int").alias("shard"), upto(blocks).alias("block"))
    asked = asked.select("vec_id", "embedding", "key", dim, dealt(blocks).cast("int").alias("block"), upto(shards).alias("shard"))
    place = ["dim", "shard", "block"]
    found = rows.groupBy(*place).cogroup(asked.groupBy(*place)).applyInArrow(
        _search_shard(k, share, least, trees, bits), "query_id bigint, query_key bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
