"""Hashed features of whole texts and linear models on them, trained by Spark ML on a bounded sample."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.llm.common import FOLD, free_name, mixed, word_hashes

#: Bytes of UTF-8 by kind: capital, other letter, digit; the rest stays.
_KIND = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b for b in range(256))


def counted_features(text: str | None) -> tuple[int, np.ndarray]:
    """The words of a text, and its distinct hashed features: words, shapes of tokens, and steps of length, variety and repetition."""
    tokens = text.encode("utf-8", "replace").split() if text else []
    if not tokens:
        return 0, np.empty(0, np.int32)
    counts = Counter(b" ".join(tokens).translate(FOLD).split())
    distinct = b" ".join(set(tokens)).translate(_KIND)
    for run in (b"aaaa", b"aa", b"aa", b"AAAA", b"AA", b"AA", b"99", b"99"):
        distinct = distinct.replace(run, run[:1])
    n = counts.total() or 1
    steps = [len(tokens).bit_length(), 10 * len(counts) // n, 10 * max(counts.values(), default=0) // n]
    kinds = [
        word_hashes(b" ".join(counts)), mixed(word_hashes(b" ".join(set(distinct.split()))) + np.uint64(1)),
        mixed(np.array([100 * i + x + 3 for i, x in enumerate(steps)], np.uint64))]
    return counts.total(), (np.concatenate(kinds) >> np.uint64(32)).astype(np.uint32).view(np.int32)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def features(text: pa.Array) -> pa.Array:
    rows = [counted_features(t)[1] for t in text.to_pylist()]
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *rows])))


def with_vector(df: DataFrame, text: str, vector: str, size: int) -> DataFrame:
    """Adds the binary vector of hashed features."""
    numbers = free_name(df, "numbers")
    df = df.withColumn(numbers, F.coalesce(features(F.col(f"`{text}`")), F.array().cast("array<int>")))
    return HashingTF(numFeatures=size, binary=True, inputCol=numbers, outputCol=vector).transform(df).drop(numbers)


def in_order(rows: DataFrame, *keys: str) -> DataFrame:
    """A bounded sample in one partition, sorted: a fit on it adds up in the same order each time, whatever the partitions before."""
    return rows.repartition(1).sortWithinPartitions(*keys)


def fit(rows: DataFrame, size: int, classes: int, iterations: int = 20, penalty: float = 1e-3) -> LogisticRegressionModel:
    """A logistic model of (vector, class, weight), from rows in one partition."""
    return LogisticRegression(
        featuresCol="vector", labelCol="class", weightCol="weight", maxIter=iterations, regParam=penalty,
        standardization=False, family="multinomial" if classes > 2 else "binomial").fit(rows.coalesce(1))


def places(numbers: np.ndarray, size: int) -> np.ndarray:
    """Distinct places of hashed features in a vector: those of HashingTF (murmur3 of an int, seed 42)."""
    with np.errstate(over="ignore"):
        x = numbers.view(np.uint32) * np.uint32(0xCC9E2D51)
        x = ((x << np.uint32(15)) | (x >> np.uint32(17))) * np.uint32(0x1B873593) ^ np.uint32(42)
        x = ((x << np.uint32(13)) | (x >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64) ^ np.uint32(4)
        x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return np.unique((x ^ (x >> np.uint32(16))).view(np.int32) % size)


def _score_udf(shared, size: int):
    @F.arrow_udf("struct<words:bigint,chances:array<double>>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, intercepts = shared.value
        by_place = np.ascontiguousarray(weights.T)
        for texts in batches:
            words, raw = [], np.empty((len(texts), len(intercepts)))
            for i, text in enumerate(texts.to_pylist()):
                n, numbers = counted_features(text)
                words.append(n)
                raw[i] = by_place[places(numbers, size)].sum(axis=0) + intercepts
            chances = np.exp(raw - raw.max(axis=1, keepdims=True)) if len(raw) else raw
            chances /= chances.sum(axis=1, keepdims=True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, chances.size + 1, len(intercepts)), pa.int32()), pa.array(chances.ravel()))
            yield pa.StructArray.from_arrays([pa.array(words, pa.int64()), lists], ["words", "chances"])

    return score


def score(df: DataFrame, model: LogisticRegressionModel, text: str, name: str, size: int) -> DataFrame:
    """Adds a struct of the text's words and the classes' probabilities, from one call for a batch of texts."""
    weights, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    if len(intercepts) == 1:  # of two classes, the model has the second against the first
        weights, intercepts = np.vstack((0 * weights, weights)), np.append(0.0, intercepts)
    shared = df.sparkSession.sparkContext.broadcast((weights, intercepts))
    return df.withColumn(name, _score_udf(shared, size)(F.col(f"`{text}`")))
