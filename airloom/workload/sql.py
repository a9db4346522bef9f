"""SQL text for the comparison side: cleaned observations and window features, step by step."""

from ..schema import NON_NEGATIVE, POINT_COLUMNS
from .views import obs_sql

BY_TIME = "PARTITION BY station ORDER BY datetime"


def cleaned_sql(body: str, cols: list[str], extra: str = "") -> str:
    """Interpolate by row position in both directions, then clip, over a query with unique keys."""
    back = "OVER (PARTITION BY station ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = "OVER (PARTITION BY station ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    near, out = [], []
    for c in cols:
        near.append(
            f"last_value({c} IGNORE NULLS) {back} AS {c}_bv, "
            f"last_value(CASE WHEN {c} IS NOT NULL THEN p END IGNORE NULLS) {back} AS {c}_bp, "
            f"first_value({c} IGNORE NULLS) {ahead} AS {c}_av, "
            f"first_value(CASE WHEN {c} IS NOT NULL THEN p END IGNORE NULLS) {ahead} AS {c}_ap"
        )
        filled = (
            f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_bv IS NULL THEN {c}_av "
            f"WHEN {c}_av IS NULL THEN {c}_bv "
            f"ELSE ({c}_av - {c}_bv) / ({c}_ap - {c}_bp) * (p - {c}_bp) + {c}_bv END"
        )
        clipped = c in NON_NEGATIVE or c in POINT_COLUMNS
        out.append(f"CASE WHEN ({filled}) < 0 THEN 0.0 ELSE ({filled}) END AS {c}" if clipped
                   else f"{filled} AS {c}")
    return (
        f"SELECT station, datetime, {extra}{', '.join(out)} FROM (SELECT *, {', '.join(near)} FROM "
        f"(SELECT *, row_number() OVER ({BY_TIME}) - 1 AS p FROM ({body}) AS b) AS r) AS n"
    )


def cleaned_obs_sql(cols: list[str]) -> str:
    return cleaned_sql(obs_sql(cols), cols)


def rolling_sql(agg: str, c: str, rows: int, name: str) -> str:
    frame = f"OVER ({BY_TIME} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) {frame} = {rows} THEN {agg}({c}) {frame} END AS {name}"


def lag_sql(c: str, rows: int, name: str) -> str:
    return f"lag({c}, {rows}) OVER ({BY_TIME}) AS {name}"


def lead_sql(c: str, rows: int, name: str) -> str:
    return f"lead({c}, {rows}) OVER ({BY_TIME}) AS {name}"


def change_sql(c: str, rows: int, name: str) -> str:
    return f"{c} - lag({c}, {rows}) OVER ({BY_TIME}) AS {name}"


def targets_sql() -> str:
    return ", ".join(lead_sql("us_aqi", h, f"target_us_aqi_{h}h_ahead") for h in (24, 48, 72))
