"""Weather enrichment: WMO condition, flags, severity."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headway.functions.categories import weather_condition
from headway.functions.weather import weather_flags, weather_severity


def enrich_weather(weather: DataFrame) -> DataFrame:
    """Adds weather_condition, the five 0/1 flags and weather_severity (0-5).

    Computed on the weather table itself, before any join, so that unmatched
    incidents get severity 0 from the neutral fill rather than a clip of nulls.
    """
    out = weather.withColumn("weather_condition", weather_condition("weather_code"))
    out = out.withColumns(weather_flags())
    return out.withColumn("weather_severity", weather_severity())
