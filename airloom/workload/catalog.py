"""Registry of named queries, each with the SQL that must give the same rows (where SQL can)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query
    return add


def comparable(df: DataFrame) -> DataFrame:
    """Types and precision both engines share: bigint, double to six digits, plain timestamps."""
    def cast(c: str, t: str) -> str:
        if t in ("double", "float"):
            return f"round(CAST(`{c}` AS DOUBLE), {DIGITS}) + 0.0D AS `{c}`"
        if t in ("int", "smallint", "tinyint"):
            return f"CAST(`{c}` AS BIGINT) AS `{c}`"
        if t in ("timestamp", "date"):
            return f"CAST(`{c}` AS TIMESTAMP_NTZ) AS `{c}`"
        return f"`{c}`"
    return df.selectExpr(*[cast(c, t) for c, t in df.dtypes])


def comparable_sql(body: str, plain: list[str] | str, doubles: list[str] | str) -> str:
    """Select ``plain`` columns as they are and ``doubles`` rounded from ``body`` (a query)."""
    plain = plain.split() if isinstance(plain, str) else plain
    doubles = doubles.split() if isinstance(doubles, str) else doubles
    out = [*plain, *[f"round(CAST({d} AS DOUBLE), {DIGITS}) + 0.0 AS {d}" for d in doubles]]
    return f"SELECT {', '.join(out)} FROM ({body}) AS t"
