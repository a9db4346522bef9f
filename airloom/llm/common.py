"""What several operators share: words, row helpers, written intermediates and ranks over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airloom.session import new_path

#: A run of letters and digits; everything beyond ASCII counts as a letter.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of UTF-8: A-Z to a-z, what separates words to a space, the rest as it is.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text as UTF-8; none for null."""
    return text.encode("utf-8", "replace").translate(FOLD).split() if text else []


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes, n: int = 1) -> np.ndarray:
    """64-bit hashes of all runs of n words in text with single spaces; of all words if there are fewer.

    They come from running sums over the bytes of the whole text (modulo 2^64, divided by the power at
    which a run begins), so a run costs the same whatever its length.
    """
    if not data:
        return np.empty(0, np.uint64)
    if len(_POWERS[0]) <= len(data):
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(2 * len(data) + 4096, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    codes = np.frombuffer(data, np.uint8)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((codes + np.uint64(1)) * _POWERS[0][: len(data)], out=sums[1:])
    gaps = np.flatnonzero(codes == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(data)]))
    k = min(n, len(starts))
    starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    return mixed((sums[ends] - sums[starts]) * _POWERS[1][starts] + (ends - starts).astype(np.uint64))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else kept."""
    return F.translate(text, UPPER, LOWER)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Rows that go to a Python worker at a time. Texts are long; Spark's default of 10,000 takes hundreds of MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later reads survive lost executors, lineage ends here."""
    path = new_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't use yet (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def put_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns of these names (in any case) under free ones, and the names to give back with withColumnsRenamed."""
    aside, taken = {}, df
    for c in df.columns:
        if c.lower() in names:
            aside[free_name(taken, f"own_{c}")] = c
            taken = taken.withColumnRenamed(c, next(reversed(aside)))
    return taken, aside


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str], rank: str, total: str) -> DataFrame:
    """Adds the rank (from 0) of each row in its group and the rows of the group, also for hot groups.

    One range shuffle over (group, order) spreads a large group over several tasks; the position of a
    row inside its sorted partition comes from monotonically_increasing_id, and a table with one row
    per (partition, group) carries the offsets. Rows equal in group and order are ranked in any order.
    Null groups form one group; an empty table stays empty.
    """
    keys = [F.col(f"`{c}`") for c in (*group, *order)]
    at, part, tie = (free_name(df, c) for c in ("at", "part", "tie"))
    spread = df.withColumn(tie, F.monotonically_increasing_id())  # splits rows equal in all keys
    spread = spread.repartitionByRange(partitions(df), *keys, tie).sortWithinPartitions(*keys, tie).drop(tie)
    spread = save(spread.withColumn(at, F.monotonically_increasing_id()), "ranked")
    spread = spread.withColumn(part, F.shiftright(at, 33)).withColumn(at, F.col(at).bitwiseAND((1 << 33) - 1))
    group_as = [f"{free_name(df, 'group')}_{i}" for i in range(len(group))]
    pieces = spread.groupBy(F.col(part).alias("p"), *[F.col(f"`{c}`").alias(g) for c, g in zip(group, group_as)]).agg(
        F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*(group_as or [F.lit(0)]))  # a row for each partition, not for each row
    before = whole.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    offset, all_rows, where = (free_name(df, c) for c in ("offset", "all_rows", "where"))
    pieces = pieces.select(
        F.col("p").alias(where), *group_as, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias(offset),
        F.sum("n").over(whole).alias(all_rows))
    same = spread[part] == pieces[where]
    for c, g in zip(group, group_as):
        same = same & spread[f"`{c}`"].eqNullSafe(pieces[g])
    joined = spread.join(pieces, same)
    return joined.select(
        *[spread[f"`{c}`"] for c in df.columns],
        (F.col(at) + F.col(offset)).alias(rank), F.col(all_rows).alias(total))


def let(value: Column, use) -> Column:
    """use(value) with the value computed once for each row, also where lambdas inside refer to it often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


CHUNK = 256


def scanned(items: Column, state: Column, step, kind: str) -> Column:
    """What step(state, item) -> (state, out) gives for each item, as an array of type `kind`; in order, no item: empty.

    Items go in chunks: an array that grows by one item costs its whole length each time, so that n items cost
    n * CHUNK + (n / CHUNK) ** 2 instead of n ** 2."""
    none, nones = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def inner(s: Column, x: Column) -> Column:
        after, out = step(s["state"], x)
        return F.struct(after.alias("state"), F.concat(s["out"], F.array(out)).alias("out"))

    def outer(items: Column):
        return lambda s, i: let(
            F.aggregate(F.slice(items, i * CHUNK + 1, CHUNK), F.struct(s["state"].alias("state"), none.alias("out")), inner),
            lambda r: F.struct(r["state"].alias("state"), F.concat(s["out"], F.array(r["out"])).alias("out")))

    def whole(items: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))
        return F.when(F.size(items) == 0, none).otherwise(F.aggregate(
            chunks, F.struct(state.alias("state"), nones.alias("out")), outer(items), lambda s: F.flatten(s["out"])))

    return let(items, whole)


def sampled(df: DataFrame, rows: int, total: int, *columns: str, seed: int = 5) -> DataFrame:
    """Distinct values of the columns, about `rows` of `total` at most, chosen by a seeded hash: the bound for model fitting."""
    share = min(1.0, rows / max(1, total))
    limit = min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64)))
    return df.select(*columns).where(F.xxhash64(F.lit(seed), *columns) <= F.lit(limit)).distinct()
