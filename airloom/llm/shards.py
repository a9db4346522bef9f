"""Proportional stratified interleaving into shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import free_name, ranked, save


def interleave(docs: DataFrame, shards: int = 8, seed: int = 20, source: str = "source", key: str = "doc_id",
               tie: tuple[str, ...] = ()) -> DataFrame:
    """Adds `shard` (from 0) and `slot` (gapless from 0 in its shard); shard sizes differ by one at most.

    Rows are shuffled within each source by a seeded digest of the key, take the middle of their
    share of the source as a fraction ((rank + 0.5) / rows), are sorted by it and cut into equal runs.
    A run of the sorted rows holds every source in its share of the table, to within one row.

    Columns other than source, key and `tie` are not sorted along: rows are numbered and written, only
    their keys are ranked, and the numbers bring shard and slot back in one shuffle.

    Null source: a source of its own. Null key: a key of its own. Repeated rows are placed one by one.
    Rows of one key are ordered by `tie` and, if other columns are there, by a hash of all. Empty
    table: no rows. Columns called shard or slot are replaced; all others stay.
    """
    docs = docs.drop("shard", "slot")
    if set(docs.columns) <= {source, key, *tie}:
        return _placed(docs, shards, seed, source, key, list(tie))
    row, hashed = free_name(docs, "row"), free_name(docs, "hash")
    numbered = save(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    slim_ = numbered.select(
        row, *dict.fromkeys([source, key, *tie]), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias(hashed))
    placed = _placed(slim_, shards, seed, source, key, [*tie, hashed]).select(F.col(row).alias("placed_row"), "shard", "slot")
    return numbered.join(placed, numbered[row] == placed["placed_row"]).select(*[numbered[f"`{c}`"] for c in docs.columns], "shard", "slot")


def _placed(docs: DataFrame, shards: int, seed: int, source: str, key: str, tie: list[str]) -> DataFrame:
    h, rank, rows, place, total, part = (free_name(docs, c) for c in ("digest", "rank", "rows", "place", "total", "fraction"))
    shuffled = docs.withColumn(h, F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))))
    shuffled = ranked(shuffled, [source], [h, key, *tie], rank, rows)
    shuffled = shuffled.withColumn(part, (F.col(rank) + F.lit(0.5)) / F.col(rows)).drop(rank, rows)
    placed = ranked(shuffled, [], [part, h, source, key, *tie], place, total)
    shard = F.expr(f"`{place}` * {shards} div `{total}`")
    first = F.expr(f"(shard * `{total}` + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col(place) - first).cast("long"))
        .drop(h, part, place, total)
    )


def slim(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (UTF-8 bytes plus 1; null text: 1) and CRC-32 of the text (null: of nothing)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
