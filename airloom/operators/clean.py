"""Repair of raw observations: duplicates, missing readings, negatives, and counts of each."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY, NON_NEGATIVE, POINT_COLUMNS
from .skew import HELPERS, HotStations, find_hot_stations, number_hot, over_station


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL both mean "missing"; keep only NULL."""
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
        for c, t in df.dtypes
    ])


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, t in df.dtypes if t in kinds and c != "station"]


def clip_columns(df: DataFrame) -> list[str]:
    return [c for c in NON_NEGATIVE + POINT_COLUMNS if c in df.columns]


def _arrival_order(df: DataFrame, seq: str | None) -> list[Column]:
    """What "first" means among rows with the same key. Where the ingest sequence does not decide,
    the row content does, so a retried task picks the same row again."""
    content = F.xxhash64(*[F.col(c) for c in df.columns])
    return [F.col(seq), content] if seq else [content]


def deduplicate(df: DataFrame, seq: str | None = None, keep: str = "first") -> DataFrame:
    """One row per ``(station, datetime)``. Spark keeps only the best row of each key per map task
    before the shuffle (window group limit), so copies of one key do not pile up in one task."""
    order = [c.asc() if keep == "first" else c.desc() for c in _arrival_order(df, seq)]
    ranked = Window.partitionBy(*KEY).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(ranked)).filter("_nth = 1").drop("_nth")


def _filled(c: str, before: str, after: str) -> str:
    """Linear in row position between the neighbours; beyond the ends the nearest value holds."""
    between = f"({after}.v - {before}.v) / ({after}.p - {before}.p) * (_pos - {before}.p) + {before}.v"
    return f"coalesce(`{c}`, {between}, {before}.v, {after}.v)"


def _reading(c: str) -> Column:
    return F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(c).alias("v")))


GROUP = 12  # columns repaired per window step: few enough for compact generated code


def _nearest(cols: list[str], keys: str) -> list[Column]:
    """The closest reading at or before, and after, each row. ``lead ... IGNORE NULLS`` moves
    forward once over the partition; a frame open to the end would be re-read for every row."""
    over = f"OVER (PARTITION BY {keys} ORDER BY datetime"
    found = []
    for c in cols:
        reading = f"IF(`{c}` IS NULL, NULL, struct(_pos AS p, `{c}` AS v))"
        found += [
            F.expr(f"last_value({reading}) IGNORE NULLS {over} "
                   "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)").alias(f"_before_{c}"),
            F.expr(f"lead({reading}) IGNORE NULLS {over})").alias(f"_after_{c}"),
        ]
    return found


def _fill(df: DataFrame, cols: list[str], keys: list[str], carried: bool) -> DataFrame:
    """Fill missing readings, a group of columns at a time over the same partitions and order (one
    sort serves all). ``carried``: ``_in_x``/``_out_x`` hold readings from outside the partition.
    ``_imputed`` collects whether anything was filled."""
    df = df.withColumn("_imputed", F.lit(False))
    for start in range(0, len(cols), GROUP):
        group = cols[start:start + GROUP]
        found = df.select("*", *_nearest(group, ", ".join(keys)))
        out, filled = {}, []
        for c in group:
            before, after = f"_before_{c}", f"_after_{c}"
            if carried:
                before, after = f"coalesce({before}, _in_{c})", f"coalesce({after}, _out_{c})"
            out[c] = f"{_filled(c, before, after)} AS `{c}`"
            filled.append(f"`{c}` IS NULL AND coalesce({before}, {after}) IS NOT NULL")
        out["_imputed"] = f"_imputed OR {' OR '.join(filled)} AS _imputed"
        df = found.selectExpr(*[out.get(c, f"`{c}`") for c in df.columns])
    return df


def _finish(df: DataFrame, clip: list[str], flag: bool) -> DataFrame:
    kept = [c for c in df.columns if c != "_imputed"]
    out = [f"CASE WHEN `{c}` < 0 THEN 0.0D ELSE `{c}` END AS `{c}`" if c in clip else f"`{c}`" for c in kept]
    return df.selectExpr(*out, *(["_imputed AS was_imputed"] if flag else []))


def _clean_plain(df: DataFrame, cols, clip, seq, flag) -> DataFrame:
    """One exchange and one sort by (station, datetime, arrival) for all three steps."""
    by_arrival = Window.partitionBy("station").orderBy("datetime", "_arrival")
    by_time = Window.partitionBy("station").orderBy("datetime")
    first = (
        df.withColumn("_arrival", F.struct(*_arrival_order(df, seq)))
        .withColumn("_previous", F.lag("datetime").over(by_arrival))
        .filter(~F.col("datetime").eqNullSafe(F.col("_previous")))
        .drop("_arrival", "_previous")
        .withColumn("_pos", F.row_number().over(by_time).cast("bigint") - 1)
    )
    return _finish(_fill(first, cols, ["station"], carried=False), clip, flag).drop("_pos")


def _clean_blocked(df: DataFrame, cols, clip, seq, flag) -> DataFrame:
    """Hot stations: nearest readings inside each hour, then readings carried from other hours."""
    rows = number_hot(deduplicate(df, seq))
    edges = rows.groupBy("station", "_chunk").agg(
        *[F.max(_reading(c)).alias(f"_last_{c}") for c in cols],
        *[F.min(_reading(c)).alias(f"_first_{c}") for c in cols],
    )
    by_hour = Window.partitionBy("station").orderBy("_chunk")
    earlier = by_hour.rowsBetween(Window.unboundedPreceding, -1)
    later = (Window.partitionBy("station").orderBy(F.desc("_chunk"))
             .rowsBetween(Window.unboundedPreceding, -1))
    carried = edges.select(
        "station", "_chunk",
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in cols],
        *[F.last(f"_first_{c}", ignorenulls=True).over(later).alias(f"_out_{c}") for c in cols],
    )
    filled = _fill(rows.join(carried, ["station", "_chunk"]), cols, ["station", "_chunk"], carried=True)
    return _finish(filled.select(*rows.columns, "_imputed"), clip, flag)


def clean(
    df: DataFrame, cols: list[str] | None = None, seq: str | None = None,
    flag_imputed: bool = False, hot: HotStations | None = None,
) -> DataFrame:
    """Keep the first row of each key, fill missing readings by row position in both directions,
    then raise negatives to zero where a negative is impossible. Missing hours stay missing."""
    cols = cols if cols is not None else numeric_columns(df)
    cols = [c for c in cols if c != seq]
    df = df.withColumns({c: F.col(c).cast("double") for c in cols if dict(df.dtypes)[c] != "double"})
    hot = hot or find_hot_stations(df)
    parts = [p(df, cols, seq, flag_imputed, hot) for p in (_plain_part, _blocked_part)]
    parts = [p.drop(*HELPERS) for p in parts if p is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _plain_part(df, cols, seq, flag, hot):
    if hot.every:
        return None
    part = df if hot.none else hot.rest(df)
    return _clean_plain(part, cols, clip_columns(df), seq, flag)


def _blocked_part(df, cols, seq, flag, hot):
    if hot.none:
        return None
    return _clean_blocked(hot.pick(df), cols, clip_columns(df), seq, flag)


# --- counts ---------------------------------------------------------------------------------

def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each key. Two partial aggregations, no key list in one task."""
    per_key = df.groupBy(*KEY).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null cells over the columns, in one pass."""
    cols = cols or numeric_columns(df)
    total = F.lit(0)
    for c in cols:
        total = total + F.count_if(F.col(c).isNull())
    return df.agg(total.alias("missing_cells"))


def negative_counts(df: DataFrame) -> DataFrame:
    """Per clipped column: how many values the clip would change."""
    cols = clip_columns(df)
    one_row = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in cols])
    return one_row.unpivot([], cols, "variable", "negative_count")


def missing_hours(df: DataFrame, step: str = "1 hour", hot: HotStations | None = None) -> DataFrame:
    """Expected minus observed timestamps between a station's first and last row.

    Only the absent timestamps are generated, from each row and its successor. The expected grid
    starts at the station's first row."""
    keys = df.select(*KEY).distinct()
    start = keys.groupBy("station").agg(F.min("datetime").alias("_start"))
    length = F.expr(f"CAST(INTERVAL {step} AS INTERVAL DAY TO SECOND)")

    def following(part: DataFrame, by: list[str]) -> DataFrame:
        by_time = Window.partitionBy(*by).orderBy("datetime")
        return part.withColumn("_next", F.lead("datetime").over(by_time))

    pairs = over_station(keys, following, after=1, hot=hot)
    apart = pairs.filter(F.col("_next") > F.col("datetime") + length)
    since = F.timestamp_diff("MICROSECOND", F.col("_start"), F.col("datetime"))
    until = F.timestamp_diff("MICROSECOND", F.col("_start"), F.col("_next"))
    epoch = "TIMESTAMP_NTZ'1970-01-01'"
    micros = F.expr(f"timestampdiff(MICROSECOND, {epoch}, {epoch} + INTERVAL {step})")
    first_step = F.floor(since / micros) + 1
    last_step = F.ceil(until / micros) - 1
    return (
        apart.join(start, "station")
        .withColumn("_from", first_step).withColumn("_to", last_step)
        .filter("_from <= _to")
        .select("station", "_start", F.explode(F.sequence("_from", "_to")).alias("_k"))
        .select("station", (F.col("_start") + F.col("_k") * length).alias("datetime"))
    )
