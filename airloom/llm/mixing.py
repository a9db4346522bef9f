"""Soft-membership mixing: a classifier gives each document a posterior over domains, rates meet target totals."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm import hashed
from airloom.llm.common import WORD_ANY_CASE, free_name, ranked, sampled, save


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain of the labelled table: toxic, else clean or junk by quality. Null ids or labels: none."""
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    return one.select("doc_id", F.expr("case when toxic = 1 then 'toxic' when quality = 1 then 'clean' when quality = 0 then 'junk' end").alias("domain")).where("domain is not null")


def train_domains(docs: DataFrame, labelled: DataFrame, names: list[str], fit_rows: int = 10_000, size: int = 1 << 15) -> LogisticRegressionModel | None:
    """A multinomial model of the domains, fitted on about `fit_rows` labelled documents at most; None without any."""
    labelled = labelled.where(F.col("domain").isin(names))
    some = sampled(labelled, fit_rows, labelled.count(), "doc_id", "domain").withColumnRenamed("doc_id", "labelled_id")
    texts = docs.select("doc_id", "text").where("text is not null")
    known = texts.join(F.broadcast(some), F.col("doc_id") == F.col("labelled_id"))  # bounded by fit_rows
    known = known.groupBy("doc_id", "domain").agg(F.max("text").alias("text"))  # repeated rows count once
    number = F.array_position(F.array(*map(F.lit, names)), F.col("domain")) - 1
    rows = hashed.with_vector(known, "text", "vector", size).select(
        "doc_id", F.xxhash64("text").alias("digest"), "vector", number.cast("double").alias("class"), F.lit(1.0).alias("weight"))
    rows = save(hashed.in_order(rows, "doc_id", "class", "digest").drop("doc_id", "digest"), "labelled")
    if rows.isEmpty():
        return None
    anchors = rows.coalesce(1).limit(1).select("vector", F.explode(F.array(*[F.lit(float(i)) for i in range(len(names))])).alias("class"), F.lit(1e-3).alias("weight"))
    return hashed.fit(rows.union(anchors), size, max(3, len(names)))  # anchors: every domain has an example


def _posteriors(docs: DataFrame, model: LogisticRegressionModel | None, names: list[str], column: str, size: int) -> DataFrame:
    """Adds a struct of words and chances."""
    if model is None:  # nothing known: all domains alike
        alike = F.array(*[F.lit(1.0 / len(names))] * len(names))
        return docs.withColumn(column, F.struct(tokens(F.col("text")).alias("words"), alike.alias("chances")))
    return hashed.score(docs, model, "text", column, size)


def _replay(p: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Rates of documents with posteriors p after the given steps, from 1, never below 0."""
    rate = np.ones(len(p))
    for step in steps:
        rate = np.maximum(0.0, rate - p @ step)
    return rate


def _sums(steps: np.ndarray):
    """Of one task: expected tokens of each domain, and the sums of tokens x p x p over documents with a rate above 0."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = steps.shape[1]
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            p = batch.column("p").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            t, rate = batch.column("tokens").to_numpy(zero_copy_only=False), _replay(p, steps)
            total += (t * rate) @ p
            square += (p * (t * (rate > 0))[:, None]).T @ p
        out = np.concatenate((total, square.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(out)), pa.int32()), pa.array(out)], names=["place", "total"])

    return sums


def fit_rates(soft: DataFrame, targets: np.ndarray, rounds: int = 60, close: float = 1e-6) -> np.ndarray:
    """Steps of scaled projected gradient descent on the squared errors of expected domain totals.

    `soft` has a row (tokens, p) for each document. A document's rate depends only on its posterior and on the
    steps so far, so a round is one pass that sums K + K x K numbers in each task; no rates are stored or
    collected. The gradient is scaled by 1 / tokens for each document and by the inverse of the domains'
    matrix over documents with a rate above 0; a step that makes the largest error larger is undone and
    halved. Ends when no total is off by more than `close` of all tokens, when steps become tiny (targets
    that no nonnegative rates meet: the nearest found), or after `rounds`; the last of these warns.
    """
    k = len(targets)

    def summed(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = soft.mapInArrow(_sums(steps), "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
        out = np.zeros(k + k * k)
        out[[r["place"] for r in rows]] = [float(f"{r['total']:.12g}") for r in rows]  # digits that do not depend on the order of tasks
        return out[:k], out[k:].reshape(k, k)

    steps = np.zeros((0, k))
    now, square = summed(steps)
    if not now.sum():
        return steps
    error, length = now - targets, 1.0
    for _ in range(rounds):
        if np.abs(error).max() <= close * targets.sum() or length < 1e-3:
            break
        scaled = np.linalg.solve(square + 1e-9 * np.trace(square) * np.eye(k) + np.eye(k) * 1e-300, error)
        longer = np.vstack((steps, length * scaled))
        now, new_square = summed(longer)
        if np.abs(now - targets).max() > np.abs(error).max():
            length /= 2
            continue
        steps, error, square, length = longer, now - targets, new_square, min(1.0, 2 * length)
    else:
        warnings.warn(f"rates are not settled after {rounds} rounds: a total is off by {np.abs(error).max() / targets.sum():.2g} of all tokens", stacklevel=2)
    return steps


def _rate_udf(steps: np.ndarray):
    @F.arrow_udf("double")
    def rate(p: pa.Array) -> pa.Array:
        k = max(1, steps.shape[1])
        return pa.array(_replay(p.flatten().to_numpy(zero_copy_only=False).reshape(-1, k), steps))

    return rate


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_ANY_CASE)), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], total: float = 1.0, fit_rows: int = 10_000,
        size: int = 1 << 15, columns: list[str] | None = None, **options) -> DataFrame:
    """Adds tokens, posteriors (a double for each domain, in the order of `weights`) and rate.

    `labelled` (doc_id, domain) trains a classifier on hashed features of whole texts, on about
    `fit_rows` labelled documents at most. Nonnegative rates are fitted so that the expected tokens of
    each domain, summed over all documents as rate x tokens x posterior, come to its share of `weights`
    times `total` times all tokens: projected gradient descent from rate 1 over all documents.

    Null or empty texts have no tokens; their rate follows their posterior like any other and moves no
    total. Labels without a document, of an unknown domain or null are left out; a document with two
    labels counts for both; without any label all domains are alike. Repeated rows are documents of their
    own. Empty table: no rows. Columns called tokens, posteriors or rate are replaced; others stay, or
    only `columns`. Posteriors are written once and read by every round.
    """
    names, share = list(weights), np.array(list(weights.values()), float)
    docs = docs.drop("tokens", "posteriors", "rate")
    model = train_domains(docs, labelled, names, fit_rows, size)
    found = free_name(docs, "found")
    carried = docs.columns if columns is None else columns
    soft = save(_posteriors(docs, model, names, found, size).select(
        *[f"`{c}`" for c in carried], F.col(f"{found}.words").alias("tokens"), F.col(f"{found}.chances").alias("posteriors")), "posteriors")
    slim = soft.where("tokens > 0").select("tokens", F.col("posteriors").alias("p"))
    all_tokens = slim.agg(F.sum("tokens")).first()[0] or 0
    steps = fit_rates(slim, share / share.sum() * total * all_tokens, **options)
    return soft.withColumn("rate", _rate_udf(steps)(F.col("posteriors")) if len(steps) else F.lit(1.0))


def draw(mixed: DataFrame, seed: int = 11) -> DataFrame:
    """Each document as often as its rate says: the whole part, and once more with the chance of the rest.

    The chance is a seeded hash of id, text and, from the second on, the number among rows equal in both, so that
    repeated rows are drawn one by one and the same rates draw as many of each. tokens, posteriors and rate
    are dropped. Only a table with repeated rows is written once more, for row numbers that stay.
    """
    again, row, one, two = (free_name(mixed, c) for c in ("again", "row", "one", "two"))
    digest = {one: F.xxhash64(F.lit(1), "doc_id", "text"), two: F.xxhash64(F.lit(2), "doc_id", "text")}
    repeated = save(mixed.select(*[v.alias(k) for k, v in digest.items()]).groupBy(one, two).count().where("count > 1"), "repeated")
    if repeated.isEmpty():
        mixed = mixed.withColumn(again, F.lit(None).cast("bigint"))
    else:
        numbered = save(mixed.withColumn(row, F.monotonically_increasing_id()), "numbered")
        keys = numbered.select(row, *[v.alias(k) for k, v in digest.items()]).join(repeated, [one, two], "left_semi")
        places = ranked(keys, [one, two], [row], "place", "rows").where("place > 0").select(F.col(row).alias("n"), F.col("place").alias("again"))
        places = save(places, "places")
        mixed = numbered.join(places, numbered[row] == places["n"], "left").select(
            *[numbered[f"`{c}`"] for c in mixed.columns], places["again"].alias(again))
    chance = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text", again), F.lit(1 << 53)) / F.lit(float(1 << 53))
    copies = (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    number = free_name(mixed, "number")
    drawn = mixed.withColumn(number, copies).where(F.col(number) > 0)
    return drawn.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(number)))).drop(number, again, "tokens", "posteriors", "rate")
