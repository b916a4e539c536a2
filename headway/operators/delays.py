"""The fact table ``delays``: typed incidents + calendar + flags + hourly weather."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headway.operators.clean import add_calendar, add_reliability_flags
from headway.operators.enrich import enrich_weather
from headway.operators.joins import join_weather


def build_delays(incidents: DataFrame, weather: DataFrame, keys: tuple[str, ...] = ("date", "hour")) -> DataFrame:
    """``incidents`` needs route, date, hour, delay_min, incident_category (and any
    carried columns); ``weather`` the raw hourly measurements with weather_code.

    Narrow transformations plus one left join on ``keys``: while the weather is small
    enough to be broadcast, the incident side is scanned once and never shuffled.
    """
    inc = add_reliability_flags(add_calendar(incidents))
    return join_weather(inc, enrich_weather(weather), keys=keys)
