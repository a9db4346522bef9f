"""From raw documents to shards: quality, near duplicates, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of the documents, extra ones and
those named like an operator's own included; the last adds shard and slot, in place of columns of these
names. Nulls, empty texts, repeated rows and empty tables are treated as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airloom.llm import decontaminate, jaccard, mixing, quality, shards
from airloom.llm.common import put_aside, save, small_batches

#: Shares of tokens by domain after mixing; rates of plain good text come out at about 1 or more.
MIXTURE = {"clean": 0.95, "toxic": 0.04, "junk": 0.01}
SHARDS = 8

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    small_batches(spark)
    return quality.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    small_batches(spark)
    return jaccard.deduplicate(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    small_batches(spark)
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn as often as their fitted rates say."""
    small_batches(spark)
    labelled = mixing.domains_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held, aside = put_aside(docs, "tokens", "posteriors", "rate")
    return mixing.draw(mixing.mix(held, labelled, MIXTURE)).withColumnsRenamed(aside).select(*[f"`{c}`" for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    small_batches(spark)
    return shards.interleave(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good), ("jaccard_join", deduplicate), ("decontamination", remove_leaks), ("mixing", mix),
    ("sharding", shard),
]

#: EM, a trained classifier and fitted rates cannot be written in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
