"""AQI health categories and alerts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import round_half_even

# --- Fixed values: category ranges with colour and advice, alert limits and text ---
BREAKPOINTS = [
    (0, 50, "Good", "#00e400", "Air quality is satisfactory, poses little or no risk."),
    (51, 100, "Moderate", "#ffff00", "Acceptable; may pose a risk for a very small group of people."),
    (101, 150, "Unhealthy for Sensitive Groups", "#ff7e00", "Sensitive groups may experience health effects."),
    (151, 200, "Unhealthy", "#ff0000", "Everyone may begin to experience health effects."),
    (201, 300, "Very Unhealthy", "#8f3f97", "Health alert: everyone may experience more serious effects."),
    (301, 500, "Hazardous", "#7e0023", "Health warning of emergency conditions -- entire population affected."),
]
UNKNOWN = ("Unknown", "#9e9e9e", "No data available.")
WARNING_FROM = 150
SEVERE_FROM = 200
ALERT_TEXT = "%s: AQI forecast for %s is %s (%s). %s"  # heading, horizon, value, category, advice
HEADINGS = {"severe": "Severe alert", "warning": "Warning"}
# --- end of fixed values ---


def classify(value: Column, mode: str = "reference") -> Column:
    """Struct (category, color, message, value).

    ``reference``: the whole-number ranges are tested as they stand, so a value in a gap (50.5), a
    negative, or one above 500 falls to the top range. ``contiguous``: each range ends at its upper
    limit and the next begins there; negatives fall to the lowest."""
    if mode not in ("reference", "contiguous"):
        raise ValueError(mode)

    def entry(category: str, color: str, message: str, shown: Column) -> Column:
        return F.struct(F.lit(category).alias("category"), F.lit(color).alias("color"),
                        F.lit(message).alias("message"), shown.alias("value"))

    shown = round_half_even(value.cast("double"), 1)
    missing = value.isNull() | F.isnan(value.cast("double"))
    chosen = F.when(missing, entry(*UNKNOWN, F.lit(None).cast("double")))
    for low, high, *labels in BREAKPOINTS:
        inside = value.between(low, high) if mode == "reference" else value <= high
        chosen = chosen.when(inside, entry(*labels, shown))
    return chosen.otherwise(entry(*BREAKPOINTS[-1][2:], shown))


def severity(value: Column) -> Column:
    return F.when(value >= SEVERE_FROM, "severe").when(value >= WARNING_FROM, "warning")


def alerts(forecasts: DataFrame, value: str = "predicted_aqi", horizon: str = "horizon_hours",
           mode: str = "reference") -> DataFrame:
    """Rows at or above the warning limit, with severity and message text."""
    label = F.concat(F.col(horizon).cast("string"), F.lit("h"))
    return (
        forecasts.withColumn("severity", severity(F.col(value)))
        .filter(F.col("severity").isNotNull())
        .withColumn("_c", classify(F.col(value), mode))
        .select(
            *[c for c in ("station", "target_datetime") if c in forecasts.columns],
            label.alias("horizon"), "severity", F.col("_c.value").alias("value"),
            F.col("_c.category").alias("category"),
            F.format_string(
                ALERT_TEXT, F.when(F.col("severity") == "severe", HEADINGS["severe"]).otherwise(HEADINGS["warning"]), label,
                F.col("_c.value").cast("string"), F.col("_c.category"), F.col("_c.message"),
            ).alias("message"),
        )
    )
