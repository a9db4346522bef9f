"""Public-holiday calendars: a table (holiday_date, name), given as a file or built by rule."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: civil holidays of Pakistan as (month, day, name, first year, years without it) ---
CIVIL_HOLIDAYS = [
    (2, 5, "Kashmir Solidarity Day", 1990, range(0)),
    (3, 23, "Pakistan Day", 1956, range(0)),
    (5, 1, "Labour Day", 1972, range(0)),
    (8, 14, "Independence Day", 1947, range(0)),
    (11, 9, "Iqbal Day", 1948, range(2015, 2022)),
    (12, 25, "Quaid-e-Azam Day", 1948, range(0)),
]
# Holidays of the lunar calendar as (month, first day, number of days, name).
LUNAR_HOLIDAYS = [
    (10, 1, 3, "Eid-ul-Fitr"),
    (12, 10, 3, "Eid-ul-Adha"),
    (3, 12, 1, "Eid Milad-un-Nabi"),
    (1, 9, 2, "Ashura"),
]
# --- end of fixed values ---

HOLIDAY_SCHEMA = "holiday_date date, name string"


def _lunar_date(year: int, month: int, day: int) -> date:
    """Arithmetic lunar calendar (30-year cycle). Announced dates can differ by a day."""
    days = (year - 1) * 354 + (3 + 11 * year) // 30 + 29 * (month - 1) + month // 2 + day
    return date(622, 7, 19) + timedelta(days=days - 1)


def holiday_calendar(
    spark: SparkSession, first_year: int, last_year: int, lunar: bool = True,
) -> DataFrame:
    """Civil holidays, and estimated lunar ones. For announced dates read a file with
    :func:`read_holidays`."""
    rows = [
        (date(y, m, d), name) for y in range(first_year, last_year + 1)
        for m, d, name, since, without in CIVIL_HOLIDAYS if y >= since and y not in without
    ]
    if not lunar or first_year > last_year:
        return spark.createDataFrame(sorted(rows), HOLIDAY_SCHEMA)
    lunar_years = range(int((first_year - 622) * 33 / 32), int((last_year - 621) * 33 / 32) + 2)
    for y in lunar_years:
        for month, first, length, name in LUNAR_HOLIDAYS:
            for extra in range(length):
                day = _lunar_date(y, month, first) + timedelta(days=extra)
                if first_year <= day.year <= last_year:
                    rows.append((day, name))
    return spark.createDataFrame(sorted(rows), HOLIDAY_SCHEMA)


def holidays_of(df: DataFrame, lunar: bool = True) -> DataFrame:
    """The calendar of the years that the rows of ``df`` span."""
    span = df.agg(F.min(F.year("datetime")).alias("first"), F.max(F.year("datetime")).alias("last")).first()
    first, last = (span.first, span.last) if span.first is not None else (1, 0)
    return holiday_calendar(df.sparkSession, first, last, lunar)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HOLIDAY_SCHEMA).option("header", True).csv(path)


def flag_holidays(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """``is_public_holiday`` by date. The broadcast side is one row per date, so the calendar
    bounds it: 366 rows a year. A date in a year before the calendar's first or after its last
    raises when its row is computed, instead of passing as an ordinary day."""
    dates = holidays.select(F.col("holiday_date").alias("_holiday")).distinct()
    span = holidays.agg(F.min(F.year("holiday_date")).alias("first"), F.max(F.year("holiday_date")).alias("last")).first()
    year = F.year("datetime")
    outside = (F.lit(True) if span.first is None else ~year.between(span.first, span.last)) & year.isNotNull()
    error = F.raise_error(F.concat(F.lit("no holiday calendar for the year "), year.cast("string")))
    joined = df.join(F.broadcast(dates), F.to_date("datetime") == F.col("_holiday"), "left")
    return joined.withColumn(
        "is_public_holiday", F.when(outside, error.cast("int")).otherwise(F.col("_holiday").isNotNull().cast("int"))
    ).drop("_holiday")
