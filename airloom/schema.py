"""Names, types and constants of the data model."""

from pyspark.sql import types as T

KEY = ["station", "datetime"]
TARGET = "us_aqi"
HORIZONS = (24, 48, 72)

# --- Fixed values: variable names, lag hours, periods and column lists of the data model ---
WEATHER_VARS = [
    "temperature_2m", "relative_humidity_2m", "precipitation", "pressure_msl", "cloud_cover",
    "wind_speed_10m", "wind_direction_10m", "dew_point_2m", "apparent_temperature",
    "vapour_pressure_deficit", "wind_gusts_10m", "cloud_cover_low", "cloud_cover_mid",
    "cloud_cover_high", "surface_pressure",
]
AIR_QUALITY_VARS = [
    "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "us_aqi",
]
AIR_QUALITY_MIN_DATE = "2022-08-01"
CHUNK_DAYS = 90

BEARINGS = {"N": 0, "E": 90, "S": 180, "W": 270}
POINT_DISTANCE_KM = 50.0
EARTH_RADIUS_KM = 6371.0

AQI_LAG_HOURS = [6, 12, 24, 36, 48, 60, 72]
POLLUTANT_LAG_HOURS = [24, 48, 72]
POLLUTANT_SHORT_NAMES = {
    "pm25": "pm2_5", "no2": "nitrogen_dioxide", "pm10": "pm10",
    "co": "carbon_monoxide", "so2": "sulphur_dioxide", "ozone": "ozone",
}
DAY_WINDOW = 24
LONG_WINDOW = 168
CYCLE_PERIODS = {"hour": 24, "month": 12, "day_of_year": 366}
NON_NEGATIVE = [
    "precipitation", "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide",
    "sulphur_dioxide", "ozone", "us_aqi",
]
DISTRIBUTION_POLLUTANTS = [
    "pm2_5", "pm10", "nitrogen_dioxide", "ozone", "carbon_monoxide", "sulphur_dioxide",
]
LOW_VALUE_FEATURES = [
    "precipitation", "is_rush_hour", "temperature_2m", "pressure_msl_change_3h",
    "ozone_lag_48h", "co_lag_24h", "wind_speed_10m", "ozone_lag_72h",
    "relative_humidity_2m", "pm25_change_rate_1h", "ozone_lag_24h", "hour_cos",
]
LOOKBACK_DAYS = 10
RETENTION_YEARS = 4
OUTLIER_PERIOD_END = "2023-09-01"
OUTLIER_PERIOD_WEIGHT = 0.3
# --- end of fixed values ---

TARGETS = [f"target_{TARGET}_{h}h_ahead" for h in HORIZONS]
EDGE_SENSITIVE = [
    "aqi_lag_72h", "aqi_rolling_mean_24h",
    *[f"{p}_rolling_mean_{LONG_WINDOW}h" for p in ("aqi", "pm2_5", "pm10")],
    *TARGETS,
]
POINT_COLUMNS = [f"{v}_dir_{b}" for v in ("pm2_5", "us_aqi") for b in BEARINGS]


def payload_schema(variables: list[str]) -> T.StructType:
    """One landing payload: a struct ``hourly`` of parallel arrays, plus the station it is for."""
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    return T.StructType([
        T.StructField("station", T.LongType()),
        T.StructField("hourly", T.StructType(arrays)),
    ])


def observation_schema(variables: list[str]) -> T.StructType:
    return T.StructType([
        T.StructField("station", T.LongType()),
        T.StructField("datetime", T.TimestampNTZType()),
        *[T.StructField(v, T.DoubleType()) for v in variables],
    ])
