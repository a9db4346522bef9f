"""Source divergence audit: Arrow kernels count terms by language and source, merged counts give exact divergences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.common import save

#: What stands between terms: everything of ASCII but letters.
GAPS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
PRIOR = 5

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _merged(tables: list[pa.Table]) -> pa.Table:
    all_rows = pa.concat_tables(tables)
    sums = all_rows.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(_COUNTS.names)


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """Terms of a batch by language and source: places and documents; the term '' (0 of both) tells that the group occurs."""
    string = lambda name: batch.column(name).cast(pa.string()).fill_null("")
    rows = pa.table({"lang": string("lang"), "source": string("source"), "row": pa.array(np.arange(batch.num_rows), pa.int32())})
    split = pc.split_pattern_regex(pc.ascii_lower(string("text")), GAPS)
    terms = pc.list_flatten(split).dictionary_encode()
    places = pa.table({"row": pc.list_parent_indices(split).cast(pa.int32()), "term": terms.indices})
    by_row = places.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    named = by_row.append_column("lang", rows["lang"].take(by_row["row"])).append_column("source", rows["source"].take(by_row["row"]))
    named = named.append_column("lang_no", named["lang"].combine_chunks().dictionary_encode().indices)
    named = named.append_column("source_no", named["source"].combine_chunks().dictionary_encode().indices)
    sums = named.group_by(["lang_no", "source_no", "term"], use_threads=False).aggregate([
        ("count_all", "sum"), ("count_all", "count"), ("lang", "min"), ("source", "min")])
    words = pa.table({
        "lang": sums["lang_min"], "source": sums["source_min"], "term": terms.dictionary.take(sums["term"].combine_chunks()),
        "n": sums["count_all_sum"], "docs": sums["count_all_count"]}, _COUNTS)
    groups = rows.group_by(["lang", "source"], use_threads=False).aggregate([])
    zero = pa.array(np.zeros(len(groups), np.int64))
    here = pa.table({"lang": groups["lang"], "source": groups["source"], "term": pa.array([""] * len(groups)), "n": zero, "docs": zero}, _COUNTS)
    return pa.concat_tables([words.filter(pc.not_equal(words["term"], "")), here])


def _partial(most: int):
    """Counts of a task, merged beyond `most` rows and given out where that many are left."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows:
                held.append(_counted(batch))
            if sum(map(len, held)) > 2 * most:
                held = [_merged(held)]
                if len(held[0]) > most:
                    yield from held.pop().combine_chunks().to_batches(max_chunksize=50_000)
        if held:
            yield from _merged(held).combine_chunks().to_batches(max_chunksize=50_000)

    return count


def count_terms(docs: DataFrame, most: int = 300_000) -> DataFrame:
    """lang, source, term, n (places) and docs (documents with the term); the term '' marks each group that occurs.

    Dealt out by language and term, so that what is summed by them next needs no other shuffle.
    """
    partial = docs.select("lang", "source", "text").mapInArrow(_partial(most), "lang string, source string, term string, n long, docs long")
    return partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _chance(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE x (n + PRIOR) / (total + PRIOR x kept)) in decimals, which no corpus overflows."""
    return F.expr("1 + cast({0} as decimal(10, 0)) * cast({1} + {2} as decimal(20, 0)) div cast({3} + {2} * {4} as decimal(20, 0))".format(
        SCALE, n, PRIOR, total, kept))


def _distances(shared, cells: int):
    """Of one block of sources and a share of the terms: distances to every source of the language, summed over those terms."""

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = shared.value
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            langs, blocks = batch.column("lang_no").to_numpy(), batch.column("block").to_numpy()
            ends = np.concatenate(([0], np.cumsum(batch.column("places").value_lengths().to_numpy())))
            flat = batch.column("places").flatten()
            source, p = flat.field("source_no").to_numpy(), flat.field("p").to_numpy()
            for lang, block in sorted(set(zip(langs.tolist(), blocks.tolist()))):
                none, height = least[lang]
                first, last = block * height, min(len(none), (block + 1) * height)
                total = sums.setdefault((lang, block), np.zeros((last - first, len(none)), np.int64))
                rows = np.flatnonzero((langs == lang) & (blocks == block))
                step = max(1, cells // len(none))
                for some in (rows[i : i + step] for i in range(0, len(rows), step)):
                    at = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in some])
                    matrix = np.repeat(none[None], len(some), axis=0)
                    matrix[np.repeat(np.arange(len(some)), ends[some + 1] - ends[some]), source[at]] = p[at]
                    for i in range(first, last):
                        total[i - first] += np.abs(matrix - matrix[:, i : i + 1]).sum(axis=0)
        for (lang, block), total in sums.items():
            height = least[lang][1]
            for i, line in enumerate(total):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(line), lang), pa.int32()), pa.array(np.full(len(line), block * height + i), pa.int32()),
                    pa.array(np.arange(len(line)), pa.int32()), pa.array(line)], names=["lang_no", "source_no", "other_no", "value"])

    return distances


def audit_sources(docs: DataFrame, min_docs: int = 30, ranks: int = 50, cells: int = 1 << 21) -> DataFrame:
    """lang, source, part, item, value and rank: how far the sources of a language are apart, and the terms that set each apart.

    Terms are runs of letters, everything beyond ASCII counts as one, A-Z lower-cased; a language keeps those in
    `min_docs` of its documents or more. Chances of terms are whole billionths (see `_chance`). Part `pair` has the sum
    of their differences over all kept terms for each other source; part `term` the `ranks` terms more usual in
    the source than in its language.

    Arrow kernels count terms inside the tasks, and their partial counts meet in one shuffle; kept terms are written as columns.
    A task that compares sources takes a share of the terms and a block of sources (`cells` numbers at a time), and
    its sums have one row a pair. The driver holds a row a (language, source), of which the result has the squares.

    Null lang, source or text: ''. A group without terms, or a language that keeps none, has pairs all the same (value 0 in the
    latter). Repeated rows are documents of their own; equal values are ranked by item. Other columns are ignored. No documents: no rows.
    """
    spark = docs.sparkSession
    same = Window.partitionBy("lang", "term")
    counts = count_terms(docs).withColumns({"lang_docs": F.sum("docs").over(same), "lang_n": F.sum("n").over(same)})
    counts = save(counts.where((F.col("lang_docs") >= min_docs) | (F.col("term") == "")), "terms")
    groups, here = counts.where("term = ''").select("lang", "source"), counts.where("term <> ''")
    of_lang = here.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n")).groupBy("lang").agg(
        F.sum("lang_n").alias("lang_total"), F.count("*").alias("size"))
    of_group = here.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sized = groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["total", "lang_total", "size"])
    sized = sized.withColumn("source_no", number).withColumn("lang_no", F.dense_rank().over(Window.orderBy("lang")) - 1)
    sized = save(sized.withColumn("none", F.when(F.col("size") > 0, _chance("0", "total", "size")).otherwise(0)), "groups")
    least: dict[int, list[int]] = {}
    for r in sized.select("lang_no", "source_no", "none").orderBy("lang_no", "source_no").toLocalIterator():
        least.setdefault(r["lang_no"], []).append(r["none"])
    heights = {i: max(1, min(len(none), cells // len(none))) for i, none in least.items()}
    shared = spark.sparkContext.broadcast({i: (np.array(none, np.int64), heights[i]) for i, none in least.items()})
    chance = here.join(F.broadcast(sized.drop("none")), ["lang", "source"]).select(  # a row a group, as the driver's list
        "lang", "source", "lang_no", "source_no", "term", _chance("n", "total", "size").alias("p"), _chance("lang_n", "lang_total", "size").alias("q"))
    blocks = spark.createDataFrame(
        [(i, b) for i, none in least.items() for b in range(-(-len(none) // heights[i]))], "lang_no int, block int")
    rows = chance.groupBy("lang_no", "term").agg(F.collect_list(F.struct("source_no", "p")).alias("places"))
    sums = rows.join(F.broadcast(blocks), "lang_no").select("lang_no", "block", "places").mapInArrow(
        _distances(shared, cells), "lang_no int, source_no int, other_no int, value long").groupBy("lang_no", "source_no", "other_no").agg(F.sum("value").alias("value"))
    one, other = sized.select("lang", "source", "lang_no", "source_no"), sized.select(
        "lang_no", F.col("source").alias("item"), F.col("source_no").alias("other_no"))
    pairs = one.join(other, "lang_no").where("source_no <> other_no").join(sums, ["lang_no", "source_no", "other_no"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    terms = chance.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    whole = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", whole).unionByName(terms.withColumn("rank", whole).where(F.col("rank") <= ranks))
