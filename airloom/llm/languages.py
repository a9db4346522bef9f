"""Language identification in two steps: the family, then one-versus-one linear support vector machines inside it."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Mapping
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import mixed, save

#: Languages by family; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af fy lb yi sco", "nordic": "sv da no nb nn is fo", "romance": "fr es pt it ro ca gl oc la",
    "west slavic": "pl cs sk hsb", "east slavic": "ru uk be rue", "south slavic": "bg mk sr hr bs sl sh", "baltic": "lt lv",
    "finnic": "fi et", "turkic": "tr az kk ky uz tk tt", "semitic": "ar he mt am", "iranian": "fa ps ku tg",
    "indic": "hi ur bn pa mr gu ne", "malay": "id ms jv su tl", "chinese": "zh yue wuu",
}

_OTHER = re.compile(r"[\W\d_]+")
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def family_of(lang: str, families: Mapping[str, str] = FAMILIES) -> str:
    """By the first part of a tag (`pt-BR`: pt)."""
    tag = re.split("[-_]", lang.lower())[0]
    return next((name for name, langs in families.items() if tag in langs.split()), lang)


def grams(text: str | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of one to four bytes of the lower-cased words of a whole text, weighted by the square root of
    their share; nothing for a text without a letter."""
    kept = _OTHER.sub(" ", text.lower()) if text else ""
    if not any(map(str.isalpha, kept)):
        return np.empty(0, np.int64), np.empty(0)
    data = np.frombuffer(f" {kept.strip()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint64)
    numbers, total = [], np.zeros(len(data), np.uint64)
    for n, prime in enumerate(_PRIMES):
        total = (total[: len(data) - n] * np.uint64(256)) + data[n:] if n else data
        numbers.append(mixed(total * prime + np.uint64(n)) % np.uint64(size))
    counts = np.bincount(np.concatenate(numbers).astype(np.int64), minlength=size)
    some = np.flatnonzero(counts)
    return some, np.sqrt(counts[some] / counts.sum())


class Model(NamedTuple):
    """families: names; family: weights (families x size) and intercepts; langs: of each family; pairs: of each family, (i, j, weights, intercept)."""

    families: list[str]
    family: tuple[np.ndarray, np.ndarray] | None
    langs: list[list[str]]
    pairs: list[list[tuple[int, int, np.ndarray, float]]]
    size: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and how sure: the family's chance times the winner's least clear duel."""
        some, values = grams(text, self.size)
        if not len(some) or not self.families:
            return "und", 0.0
        at, sure = 0, 1.0
        if self.family:
            raw = self.family[0][:, some] @ values + self.family[1]
            chance = np.exp(raw - raw.max())
            at = int(chance.argmax())
            sure = float(chance[at] / chance.sum())
        langs, margins = self.langs[at], np.zeros((len(self.langs[at]),) * 2)
        for i, j, weights, intercept in self.pairs[at]:
            margins[i, j] = weights[some] @ values + intercept
            margins[j, i] = -margins[i, j]
        won = np.lexsort((margins.sum(axis=1), (margins > 0).sum(axis=1)))[-1]  # most duels, then the clearest
        duels = np.delete(margins[won], won)
        return langs[won], sure / (1 + float(np.exp(-2 * np.clip(duels.min(), -20, 20)))) if len(duels) else sure


def is_held_out(doc_id: Column) -> Column:
    """A third of the ids, by their checksum; a null id isn't."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(labelled: DataFrame, fit_rows: int = 1500, size: int = 1 << 13, families: Mapping[str, str] = FAMILIES, seed: int = 13) -> Model:
    """Fits on (text, lang): about `fit_rows` texts of each language at most, chosen by a seeded hash, each text once.

    The chosen texts' features are written in a fixed order into one partition, so that the same texts give
    the same model; their number is bounded by `fit_rows` and the languages there are.
    """
    spark = labelled.sparkSession
    labelled = labelled.where("lang is not null and text is not null").select("text", "lang")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return Model([], None, [], [], size)
    top = (1 << 63) - 1
    limits = spark.createDataFrame([(k, min(top, int(-(1 << 63) + min(1.0, fit_rows / n) * (1 << 64)))) for k, n in counts.items()], "lang string, most long")
    digest = F.xxhash64(F.lit(seed), "text")
    some = labelled.join(F.broadcast(limits), "lang").where(digest <= F.col("most")).select("lang", "text").distinct()

    @F.udf(VectorUDT())
    def vector(text: str) -> SparseVector:  # of the chosen texts only
        at, values = grams(text, size)
        return SparseVector(size, at.tolist(), values.tolist())

    rows = some.select("lang", vector("text").alias("features"), F.sha2("text", 256).alias("key"))
    rows = save(rows.repartition(1).sortWithinPartitions("key", "lang"), "texts-of-languages")
    langs: dict[str, list[str]] = defaultdict(list)
    for lang in sorted(counts):
        langs[family_of(lang, families)].append(lang)
    names = sorted(langs)

    def numbered(groups: list[list[str]]) -> DataFrame:
        """The rows of the given languages, classes by group, weighted so that groups count alike."""
        kept = rows.where(F.col("lang").isin([x for g in groups for x in g])).coalesce(1)
        label = F.create_map(*[F.lit(v) for i, g in enumerate(groups) for x in g for v in (x, float(i))])[F.col("lang")]
        share = [sum(min(fit_rows, counts[x]) for x in g) for g in groups]
        weight = F.element_at(F.array(*[F.lit(sum(share) / len(share) / s) for s in share]), (label + 1).cast("int"))
        return kept.withColumn("label", label).withColumn("weight", weight)

    family = None
    if len(names) > 1:
        fitted = LogisticRegression(family="multinomial", weightCol="weight", regParam=1e-5, maxIter=40, standardization=False).fit(numbered([langs[n] for n in names]))
        family = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    pairs: list[list[tuple[int, int, np.ndarray, float]]] = []
    for name in names:
        pairs.append([])
        for i, j in combinations(range(len(langs[name])), 2):
            fitted = LinearSVC(weightCol="weight", regParam=1e-5, maxIter=40, standardization=False).fit(numbered([[langs[name][j]], [langs[name][i]]]))
            pairs[-1].append((i, j, fitted.coefficients.toArray(), fitted.intercept))
    return Model(names, family, [langs[n] for n in names], pairs, size)


_TYPE = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])


def _predict_udf(shared):
    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(*shared.value)
        for texts in batches:
            yield pa.array([dict(zip(("lang_pred", "score"), model.predict(t))) for t in texts.to_pylist()], _TYPE)

    return predict


def predict_languages(docs: DataFrame, model: Model, name: str = "found") -> DataFrame:
    """Adds a struct of lang_pred and score (0 to 1) from the whole text alone.

    A text that is null, empty or without a letter is `und` with 0, as is every text if nothing was learned. Where one
    language was learned, every text with a letter is that. Repeated rows have their own results; an empty table stays
    empty; a column of the name given is replaced, others stay.
    """
    return docs.withColumn(name, _predict_udf(docs.sparkSession.sparkContext.broadcast(tuple(model)))(F.col("text")))
