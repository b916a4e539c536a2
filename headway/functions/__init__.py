"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from headway.functions.numeric import r
from headway.functions.calendar import (
    day_name,
    day_of_week_mon0,
    day_of_week_sun0,
    hour_from_time_text,
    is_rush_hour,
    is_weekend,
    iso_week,
    month_name,
    time_period,
    year_month,
)
from headway.functions.categories import incident_category, weather_condition
from headway.functions.weather import weather_flags, weather_severity

__all__ = [
    "r",
    "day_name",
    "day_of_week_mon0",
    "day_of_week_sun0",
    "hour_from_time_text",
    "is_rush_hour",
    "is_weekend",
    "iso_week",
    "month_name",
    "time_period",
    "year_month",
    "incident_category",
    "weather_condition",
    "weather_flags",
    "weather_severity",
]
