"""Row-wise expressions: calendar parts, cyclical encoding, geometry, ratios, rounding."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BEARINGS, EARTH_RADIUS_KM


def calendar_parts(dt: Column) -> dict[str, Column]:
    return {
        "hour": F.hour(dt), "day": F.dayofmonth(dt), "month": F.month(dt),
        "day_of_year": F.dayofyear(dt),
    }


def is_weekend(dt: Column) -> Column:
    return F.weekday(dt).isin(5, 6).cast("int")


def is_rush_hour(dt: Column) -> Column:
    """Morning 7-9 and evening 17-20."""
    hour = F.hour(dt)
    return (hour.between(7, 9) | hour.between(17, 20)).cast("int")


def month_name(dt: Column) -> Column:
    return F.date_format(dt, "MMMM")


def cycle(c: Column, period: float) -> tuple[Column, Column]:
    angle = c * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def pm_ratio() -> Column:
    return F.col("pm2_5") / (F.col("pm10") + F.lit(1e-3))


def stagnation(wind_mean: Column, rain_sum: Column) -> Column:
    return (F.lit(1.0) / (wind_mean + 1)) * (F.lit(1.0) / (rain_sum + 1))


def destination(lat: Column, lon: Column, bearing: Column, distance_km: float) -> tuple[Column, Column]:
    """Point reached from (lat, lon) along a great circle on a sphere."""
    arc = F.lit(distance_km / EARTH_RADIUS_KM)
    phi, theta = F.radians(lat), F.radians(bearing)
    reached = F.asin(F.sin(phi) * F.cos(arc) + F.cos(phi) * F.sin(arc) * F.cos(theta))
    turned = F.atan2(F.sin(theta) * F.sin(arc) * F.cos(phi),
                     F.cos(arc) - F.sin(phi) * F.sin(reached))
    return F.degrees(reached), F.degrees(F.radians(lon) + turned)


def upwind_blend(value: str, wind_direction: Column, bearings: dict = BEARINGS) -> Column:
    """Mean of the four points weighted by how well each faces the wind. Null if any input is."""
    weight = {
        name: F.when(wind_direction.isNotNull(), F.greatest(
            F.cos(F.radians(wind_direction) - F.lit(math.radians(degrees))), F.lit(0.0)))
        for name, degrees in bearings.items()
    }
    total = sum(list(weight.values())[1:], list(weight.values())[0]) + F.lit(1e-6)
    parts = [weight[name] / total * F.col(f"{value}_dir_{name}") for name in bearings]
    return sum(parts[1:], parts[0])


def target_time(reference: Column, hours: Column) -> Column:
    return reference + F.make_interval(hours=hours)


def round_half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def strip_zone(c: Column) -> Column:
    """Drop the zone label and keep the wall-clock value (session time zone UTC)."""
    return c.cast("timestamp_ntz")
