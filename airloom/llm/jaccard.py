"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import free_name, mixed, save, word_hashes, words

def ngram_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all n-grams of words; a text of fewer words is one n-gram. No words: empty."""
    return np.unique(word_hashes(b" ".join(words(text)), n))


def choose_bands(threshold: float = 0.8, recall: float = 0.9999, max_hashes: int = 128) -> tuple[int, int]:
    """Bands and rows: the most rows for which a pair at the threshold shares a band with the given probability,
    within `max_hashes` or, if one row takes more, with as many bands of one row as that needs."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)) if threshold < 1 else 1, 1)
    for rows in range(1, max_hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))) if threshold < 1 else 1
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def permutations(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Masks and odd factors of as many permutations of 32-bit numbers: x -> (x ^ mask) * factor."""
    mask, factor = np.random.default_rng(seed).integers(0, 1 << 32, (2, count, 1), dtype=np.uint32)
    return mask, factor | np.uint32(1)


def band_hashes(grams: np.ndarray, bands: int, rows: int, drawn: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One 64-bit hash for each band of MinHash values (over the upper half of each n-gram's hash)."""
    mask, factor = drawn
    least, upper = np.full(bands * rows, (1 << 32) - 1, np.uint32), (grams >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(upper), 4096):  # bounded memory for long texts
        np.minimum(least, ((upper[None, i : i + 4096] ^ mask) * factor).min(axis=1), out=least)
    values, out = least.astype(np.uint64).reshape(bands, rows), np.zeros(bands, np.uint64)
    for r in range(rows):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + values[:, r])
    return out


def set_key(grams: np.ndarray) -> str:
    """128-bit digest of an n-gram set; equal sets, equal keys."""
    return hashlib.md5(grams.tobytes()).hexdigest()


def _signature_udf(n: int, bands: int, rows: int):
    @F.arrow_udf("struct<key:string,bands:array<bigint>>")
    def signature(text: pa.Array) -> pa.Array:
        keys, all_bands, counts, drawn = [], [], [0], permutations(bands * rows)
        for t in text.to_pylist():
            grams = ngram_set(t, n)
            keys.append(set_key(grams) if len(grams) else None)
            if len(grams):
                all_bands.append(band_hashes(grams, bands, rows, drawn).view(np.int64))
            counts.append(counts[-1] + (bands if len(grams) else 0))
        flat = np.concatenate(all_bands) if all_bands else np.empty(0, np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(keys, pa.string()), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(flat))], ["key", "bands"])

    return signature


def _grams_udf(n: int):
    @F.arrow_udf("struct<key:string,grams:binary>")
    def grams(text: pa.Array) -> pa.Array:
        sets = [ngram_set(t, n) for t in text.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([set_key(s) if len(s) else None for s in sets], pa.string()), pa.array([s.tobytes() for s in sets], pa.binary())],
            ["key", "grams"])

    return grams


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set in a with every set in b."""
    if len(a) * len(b) <= 4:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in b] for x in a], np.int64)
    values, inverse = np.unique(np.concatenate(a), return_inverse=True)
    owner = np.repeat(np.arange(len(a)), [len(x) for x in a])
    at = np.searchsorted(values, other := np.concatenate(b))
    hit = np.flatnonzero((at < len(values)) & (values[np.minimum(at, len(values) - 1)] == other))
    b_owner, at = np.repeat(np.arange(len(b)), [len(y) for y in b])[hit], at[hit]
    shared, column = np.unique(at, return_inverse=True)  # columns that both sides have
    place = np.full(len(values), -1)
    place[shared] = np.arange(len(shared))
    inverse = place[inverse]
    owner, inverse = owner[inverse >= 0], inverse[inverse >= 0]
    total = np.zeros((len(a), len(b)), np.float32)  # counts below 2^24 are exact
    for lo in range(0, len(shared), 8192):
        left, right = (np.zeros((len(s), min(8192, len(shared) - lo)), np.float32) for s in (a, b))
        pick = (inverse >= lo) & (inverse < lo + 8192)
        left[owner[pick], inverse[pick] - lo] = 1
        pick = (column >= lo) & (column < lo + 8192)
        right[b_owner[pick], column[pick] - lo] = 1
        total += left @ right.T
    return total.astype(np.int64)


def _verify_unit(band: int, i: int, j: int, members: list[tuple], threshold: float) -> Iterator[tuple[str, str, int]]:
    """Links of one unit (block i against block j of a bucket): key, the smallest key it reaches here, linked documents.

    A pair is counted in the first band that it shares, so in one unit of all.
    """
    left = [m for m in members if m[1] == i]
    right = left if i == j else [m for m in members if m[1] == j]
    if not left or not right:
        return
    grams = [[np.frombuffer(m[4], np.uint64) for m in side] for side in (left, right)]
    sizes = [np.array([len(g) for g in side]) for side in grams]
    bands = [np.array([m[3] for m in side], np.int64) for side in (left, right)]
    first = np.empty((len(left), len(right)), bool)
    for x in range(len(left)):
        first[x] = (bands[0][x] == bands[1]).argmax(axis=1) == band
    if not first.any():
        return
    common = _common(*grams)
    linked = first & (common >= threshold * (sizes[0][:, None] + sizes[1][None, :] - common) - 1e-9)
    if i == j:
        np.fill_diagonal(linked, False)
    weights = [np.array([m[2] for m in side], np.int64) for side in (left, right)]
    keys = [m[0] for m in left] + ([] if i == j else [m[0] for m in right])
    if i == j:
        near, counts = linked, linked @ weights[1]
    else:
        near = np.block([[np.zeros((len(left),) * 2, bool), linked], [linked.T, np.zeros((len(right),) * 2, bool)]])
        counts = np.concatenate((linked @ weights[1], linked.T @ weights[0]))
    order = np.argsort(np.array(keys))
    label = np.empty(len(keys), np.int64)
    label[order] = np.arange(len(keys))
    while True:  # the smallest key that each member reaches inside the unit
        least = np.minimum(label, np.where(near, label[None, :], len(keys)).min(axis=1))
        least = np.minimum(least, least[order[least]])
        if (least == label).all():
            break
        label = least
    for x in np.flatnonzero(near.any(axis=1)):
        yield keys[x], keys[order[label[x]]], int(counts[x])


_LINKS = pa.schema([("key", pa.string()), ("other", pa.string()), ("links", pa.int64())])


def _verify_partition(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, members, out = None, [], []
        for batch in batches:
            for r in batch.to_pylist():
                at = (r["bucket"], r["i"], r["j"])
                if at != unit:
                    if members:
                        out += _verify_unit(unit[0]["band"], unit[1], unit[2], members, threshold)
                    unit, members = at, []
                members.append((r["key"], r["block"], r["copies"], r["bands"], r["grams"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out) if out else ((), (), ()), _LINKS)], schema=_LINKS)
            out = []
        if members:
            out = list(_verify_unit(unit[0]["band"], unit[1], unit[2], members, threshold))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out) if out else ((), (), ()), _LINKS)], schema=_LINKS)

    return verify


def components(edges: DataFrame) -> DataFrame:
    """(key, label): the smallest key that each key of `edges` (key, other) reaches, by alternating stars.

    Every round hooks larger neighbours to the smallest one, then flattens; it ends when no edge
    changes. Counts and hash sums, not edges, reach the driver.
    """
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("key", "other").cast("decimal(38,0)"))).first())
    edges = save(edges.where("key != other").select(F.greatest("key", "other").alias("key"), F.least("key", "other").alias("other")).distinct(), "edges")
    before = mark(edges)
    while before[0]:
        both = edges.union(edges.select("other", "key"))
        least = both.groupBy("key").agg(F.min("other").alias("least")).withColumn("least", F.least("key", "least"))
        large = both.where("other > key").join(least, "key").select(F.col("other").alias("key"), F.col("least").alias("other"))
        large = save(large.where("key != other").distinct(), "large")
        least = large.groupBy("key").agg(F.min("other").alias("least"))  # large: other < key
        small = large.join(least, "key").select(F.explode(F.array(
            F.struct("key", F.col("least").alias("other")), F.struct(F.col("other").alias("key"), F.col("least").alias("other")))).alias("e"))
        edges = save(small.select("e.key", "e.other").where("key != other").distinct(), "small")
        after = mark(edges)
        if after == before:
            break
        before = after
    labels = edges.groupBy("key").agg(F.min("other").alias("label"))
    return labels.union(edges.select("other", "other").distinct())


def jaccard_groups(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9999, max_hashes: int = 128,
                   block: int = 256, row: str | None = None) -> DataFrame:
    """One row per document row: doc_id, copy_id, class_id, n_copies, n_links, is_first, row.

    Similarity is the Jaccard index of the sets of word n-grams. copy_id is the smallest doc_id with
    the same set, n_copies the documents that have it; n_links counts the other documents of
    similarity `threshold` or more; class_id is the smallest doc_id connected by such links. One row
    of each class has is_first: its smallest doc_id (of repeated rows any one). `row` numbers the rows;
    the argument names a column that does so already.

    Bands and rows follow from the wanted recall of a pair at the threshold. Documents are joined by
    band hash; buckets with the same members as another are dropped, buckets of more than `block`
    members are cut into pairs of blocks, and each pair of sets is compared once, on whole sets. Copies
    take part once, so that a group of them costs one member. No pairs leave a task: only sums and, for
    each member, one link.

    Null texts and texts without words have no n-grams: no links, a class of their own each, n_copies
    1. Texts of fewer than n words are one n-gram. Null doc_id: joined like others; a class of null ids
    alone has a null class_id. Empty table: no rows.
    """
    bands, rows = choose_bands(threshold, recall, max_hashes)
    number = F.col(f"`{row}`") if row else F.monotonically_increasing_id()
    signed = docs.select("doc_id", number.alias("row"), _signature_udf(n, bands, rows)("text").alias("s"))
    signed = save(signed.select("doc_id", "row", "s.key", "s.bands"), "signatures")
    sets = signed.where("key is not null").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("copies"),
        F.min("bands").alias("bands"))
    sets = save(sets.select("key", F.col("first.doc_id").alias("copy_id"), F.col("first.row").alias("first_row"), "copies", "bands"), "sets")
    hashed = sets.select("key", F.posexplode("bands").alias("band", "hash"))
    bucket = F.struct("band", "hash")
    buckets = hashed.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("mark"),
        F.min("key").alias("low"), F.max("key").alias("high")).where("size > 1")
    # Two buckets with the same members hold the same pairs; the one of the first band is kept.
    buckets = buckets.groupBy("size", "mark", "low", "high").agg(F.min("bucket").alias("bucket"))
    buckets = buckets.select("bucket", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    members = save(hashed.withColumn("bucket", bucket).join(buckets, "bucket").select("key", "bucket", "blocks"), "members")
    wanted = members.select("key").distinct().join(sets, "key").select("copy_id").distinct()
    texts = docs.select("doc_id", "text").join(wanted, docs["doc_id"].eqNullSafe(wanted["copy_id"]), "left_semi")
    grams = texts.select(_grams_udf(n)("text").alias("g")).select("g.key", "g.grams").where("key is not null").dropDuplicates(["key"])
    full = members.select("key").distinct().join(sets.select("key", "copies", "bands"), "key").join(grams, "key")
    mine = F.pmod(F.xxhash64("key", "bucket"), F.col("blocks")).cast("int")
    units = members.withColumn("block", mine).withColumn("against", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select("key", "bucket", "block", F.least("block", "against").alias("i"), F.greatest("block", "against").alias("j"))
    units = units.join(save(full, "ngrams"), "key")
    dealt = units.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    links = save(dealt.mapInArrow(_verify_partition(threshold), "key string, other string, links bigint"), "links")
    labels = components(links.select("key", "other"))
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    known = sets.select("key", "copy_id", "copies", "first_row").join(labels, "key", "left").join(counts, "key", "left")
    known = save(known.withColumn("label", F.coalesce("label", "key")), "known")
    first = known.groupBy("label").agg(F.min(F.struct(F.col("copy_id").isNull(), "copy_id", "first_row")).alias("first"))
    known = save(known.join(first, "label").select(
        "key", "copy_id", F.col("first.copy_id").alias("class_id"), F.col("first.first_row").alias("class_row"), "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    signed = signed.select("doc_id", "row", "key")
    # Sets with a thousandth of all rows or more, a thousand of them at most, are broadcast: their rows do not meet in one task.
    met = signed.join(F.broadcast(known.where(F.col("copies") * 1000 >= signed.count())), "key", "left")
    rest = met.where("key is not null and copies is null").select("doc_id", "row", "key").join(known, "key")
    return met.where("key is null or copies is not null").unionByName(rest).select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.col("key").isNull() | (F.col("row") == F.col("class_row"))).alias("is_first"), "row")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """One row of each class of near duplicates, with its columns; rows without n-grams all stay."""
    row = free_name(docs, "row")
    numbered = save(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    first = jaccard_groups(numbered, row=row, **options).where("is_first").select(F.col("row").alias("first_row"))
    return numbered.join(first, numbered[row] == first["first_row"], "left_semi").drop(row)
