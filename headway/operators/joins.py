"""Joins of the fact table to small dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.weather import FLAG_COLUMNS

WEATHER_COLUMNS = [
    "temp_c", "precip_mm", "snow_cm", "wind_kph", "weather_condition",
    *FLAG_COLUMNS, "weather_severity",
]

# Neutral weather for incidents with no weather hour.
NEUTRAL_WEATHER = {
    "temp_c": 10.0,
    "precip_mm": 0.0,
    "snow_cm": 0.0,
    "wind_kph": 15.0,
    "weather_condition": "Unknown",
    "weather_severity": 0,
    **{c: 0 for c in FLAG_COLUMNS},
}

# A dimension is broadcast only when a bounded count says it is small (hourly
# weather: 8,784 rows a year, so this covers ~57 years at ~100 bytes a row);
# beyond this it is joined with a shuffle (and AQE may still switch at run time).
BROADCAST_MAX_ROWS = 500_000


def checked_broadcast(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(dim)`` if it has at most ``max_rows`` rows, else ``dim`` unchanged.

    The check reads at most ``max_rows + 1`` rows, so it stays cheap on a large input.
    """
    n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def join_weather(
    incidents: DataFrame,
    weather: DataFrame,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
    keys: tuple[str, ...] = ("date", "hour"),
) -> DataFrame:
    """LEFT join incidents to enriched hourly weather on ``keys``, then neutral fill.

    One place's weather is 8,784 rows a year, so up to ``max_broadcast_rows`` it is
    broadcast and the incident side is never shuffled; weather of many stations
    beyond that meets the incidents in a shuffled join.  Duplicate weather hours
    would multiply incident rows, as a plain left join does.
    """
    w = weather.select(*keys, *WEATHER_COLUMNS)
    w = checked_broadcast(w, max_broadcast_rows)
    joined = incidents.join(w, list(keys), "left")
    return joined.na.fill(NEUTRAL_WEATHER)


def match_counts() -> list[Column]:
    """Aggregates over the fact table from which the match rates follow."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum((F.col("temp_c") != F.lit(10.0)).cast("long")), F.lit(0)).alias("not_ten"),
        F.coalesce(F.sum((F.col("weather_condition") != F.lit("Unknown")).cast("long")), F.lit(0)).alias("not_unknown"),
    ]


def weather_match_rate(delays: DataFrame) -> DataFrame:
    """Share of incident rows whose temperature differs from the neutral 10 degrees.

    ``weather_match_rate`` is the published heuristic (a real 10 degree reading
    counts as unmatched); ``matched_rate`` uses the condition marker instead.
    """
    return delays.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg((F.col("temp_c") != F.lit(10.0)).cast("int")).alias("weather_match_rate"),
        F.avg((F.col("weather_condition") != F.lit("Unknown")).cast("int")).alias("matched_rate"),
    )
