"""Registered queries: against SQL where there is any, else shape and rules of the contract, and the pipeline."""

import corpus_pipeline
import numpy as np
import pytest
import test_text_operators as plain
from conftest import SF
from oracle import compare, connect

import __spark_entry__ as entry
from airloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), connect(SF).execute(entry.oracle_sql()[name]).df()
    for c in {"first_word", "last_word", "grown_shard"} & set(got.columns):  # integers with nulls
        got[c], want[c] = got[c].astype("float64"), want[c].astype("float64")
    assert compare(got, want) == ""


@pytest.mark.parametrize("name,table", [
    ("op1_soft_mixture", "documents"), ("op5_quality_classifier", "documents"), ("op7_pii", "documents"), ("op9_quotation_links", "conversations")])
def test_queries_return_every_row(spark, name, table):
    got = entry.queries()[name](spark, SF)
    ids = got.columns[0]
    assert sorted(r[0] for r in got.select(ids).collect()) == sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(ids).collect())


def test_pipeline(spark):
    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "shard", "slot"]
    kept = out.select(*docs.columns)
    assert kept.join(docs, docs.columns, "left_anti").isEmpty() and 0 < kept.distinct().count() < docs.count()
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 and toxic = 0").select("doc_id").distinct()
    clean = corpus_pipeline.keep_good(spark, docs, SF)
    assert labels.join(docs, "doc_id").select("doc_id").subtract(clean.select("doc_id")).isEmpty()


def test_later_stages_lose_no_rows(spark):
    docs = corpus_pipeline.keep_good(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    good = rows(docs)
    one = corpus_pipeline.deduplicate(spark, docs, SF)
    kept, label = rows(one), plain.classes(good)
    group = dict(zip(good, label))
    assert sorted(group[r] for r in kept) == sorted(set(label))  # one of each group
    clean = corpus_pipeline.remove_leaks(spark, one, SF)
    leaked = plain.leaks(kept, rows(spark.read.parquet(f"{SF}/benchmark.parquet").selectExpr("item_id AS doc_id", "text")))
    assert sorted(rows(clean)) == sorted(r for r, x in zip(kept, leaked) if not x[5])
    out = rows(corpus_pipeline.shard(spark, clean, SF))
    assert sorted(out) == sorted(rows(clean))


def test_forest_query_finds_the_nearest(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = {}
    for r in entry.queries()["op10_prefix_forest"](spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
        a, b = rows[r["query_id"]], rows[r["vec_id"]]
        assert r["score"] == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-6)
    assert set(got) == {q for q in rows if q % 50 == 0}
    ids = np.array(list(rows))
    unit = np.stack([v / np.linalg.norm(v) for v in rows.values()])
    met = 0
    for q, found in got.items():
        order = ids[np.argsort(-(unit @ (rows[q] / np.linalg.norm(rows[q]))))]
        best = set(order[order != q][:5])
        assert len(found) == 5
        met += len(found & best)
    assert met >= 0.95 * 5 * len(got)


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_rows(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "x" * 100_000, None, "src0", None)], docs.schema)
    names = ["row", "keep", "place", "digest", "Leak", "RATE", "Tokens", "posteriors", "Weak"]
    ids = lambda df: sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda x: (x is not None, x))
    for rows in (docs.limit(0), odd, odd.unionByName(docs.limit(20))):
        extra = rows.selectExpr("*", *[f"'{n}' AS `{n}`" for n in names])
        out = corpus_pipeline.STAGES[stage][1](spark, extra, SF)
        assert out.columns == [*extra.columns, "shard", "slot"] if stage == 4 else extra.columns
        assert all(r[n] == n for r in out.select(*names).collect() for n in names)
        got, given = ids(out), ids(rows)
        if stage == 4:
            assert got == given
        elif not given:
            assert not got
        elif stage == 3:  # texts without words follow their posterior
            assert set(got) <= set(given)
        elif stage == 2:
            want = plain.leaks([(r["doc_id"], r["text"]) for r in rows.collect()], [
                (r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
            assert len(got) == sum(not x[5] for x in want) and set(got) >= {None, 1, 2}
        elif stage == 1 and rows is odd:
            assert got == given  # texts without words are no copies of each other
        elif stage == 0:  # no words, no quality
            assert None not in got and 1 not in [r["doc_id"] for r in out.where("text = ''").collect()]


def test_mixing_can_be_repeated(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lambda df: sorted(map(str, corpus_pipeline.mix(spark, df, SF).collect()))
    assert rows(docs) == rows(docs) == rows(docs.repartition(5))
