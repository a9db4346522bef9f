"""The daily refresh of the training split, and its parts as a training run reads them."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import KEY
from ..sources import store
from .training import add_split, training_ready


def refresh_split(
    spark: SparkSession, table: str, snapshots: str, step: str = "1 hour", months: int = 12, columns: list[str] | None = None,
) -> int:
    """Training-ready rows of a stored feature table, split by time, as a new version of the training data;
    returns its number.

    A version is known by the change of the table that it was made from: if the table has not changed, the job returns
    the version that is there, so that it can be run again after a failure. A table without training-ready
    rows raises and makes no version."""
    rows, change = store.read_state(spark, table)
    made = store.noted_bounds(spark, snapshots).filter(F.col("source") == change).agg(F.max("version")).first()[0]
    if made is not None:
        return made
    ready = training_ready(rows, columns)
    if ready.isEmpty():
        raise ValueError(f"{table} has no training-ready rows; the last version stays")
    return store.write_snapshot(add_split(ready, step, months), snapshots, change)


class Parts(NamedTuple):
    """Features and labels of both splits; all have the key, so that they can be joined."""

    features_train: DataFrame
    labels_train: DataFrame
    features_test: DataFrame
    labels_test: DataFrame


def split_parts(
    spark: SparkSession, snapshots: str, features: list[str], labels: list[str], version: int | None = None, check: bool = True,
) -> Parts:
    """The parts of a version (the newest by default). Only their columns are read.

    ``check``: raise unless the rows of each split can be put in one strict order of time per station and all
    training rows come before all test rows."""
    rows = store.read_snapshot(spark, snapshots, version)
    absent = [c for c in (*KEY, "split", *features, *labels) if c not in rows.columns]
    if absent:
        raise ValueError(f"version {version or 'latest'} lacks columns: {absent}")
    if check and (faults := order_faults(rows)):
        raise ValueError(f"the split is out of order: {faults}")
    train, test = (rows.filter(F.col("split") == s) for s in ("train", "test"))
    return Parts(*(part.select(*KEY, *cols) for part in (train, test) for cols in (features, labels)))


def order_faults(rows: DataFrame) -> dict[str, int]:
    """Faults by kind, without the kinds that do not occur: rows that share a key with another row of their split,
    rows without a key, and training rows at or after the first test row."""
    per_key = rows.groupBy("split", *KEY).agg(F.count("*").alias("n"))
    no_key = F.col("station").isNull() | F.col("datetime").isNull()
    first = rows.filter("split = 'test'").agg(F.min("datetime").alias("t")).first().t
    late = F.lit(False) if first is None else (F.col("split") == "train") & (F.col("datetime") >= F.lit(first).cast("timestamp_ntz"))
    found = per_key.agg(
        F.sum(F.when(~no_key, F.col("n") - 1)).alias("repeated"), F.sum(F.when(no_key, F.col("n"))).alias("without_key"),
        F.sum(F.when(late, F.col("n"))).alias("train_after_test")).first().asDict()
    return {kind: n for kind, n in found.items() if n}
