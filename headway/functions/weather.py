"""Weather flags and the composite severity score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag thresholds (all strict comparisons).
PRECIP_MM = 0.2
HEAVY_PRECIP_MM = 5.0
SNOW_CM = 0.1
EXTREME_COLD_C = -10.0
HIGH_WIND_KPH = 40.0

# Severity weights, clipped to [0, 5].
SEVERITY_WEIGHTS = {
    "is_heavy_precip": 3,
    "is_snow": 2,
    "is_precipitation": 1,
    "is_extreme_cold": 2,
    "is_high_wind": 1,
}
SEVERITY_MAX = 5

FLAG_COLUMNS = ["is_precipitation", "is_heavy_precip", "is_snow", "is_extreme_cold", "is_high_wind"]


def _flag(cond: Column) -> Column:
    return F.coalesce(cond.cast("int"), F.lit(0))


def weather_flags(precip="precip_mm", snow="snow_cm", temp="temp_c", wind="wind_kph") -> dict[str, Column]:
    """0/1 flags; a missing measurement gives 0."""
    p, s, t, w = (F.col(x) if isinstance(x, str) else x for x in (precip, snow, temp, wind))
    return {
        "is_precipitation": _flag(p > F.lit(PRECIP_MM)),
        "is_heavy_precip": _flag(p > F.lit(HEAVY_PRECIP_MM)),
        "is_snow": _flag(s > F.lit(SNOW_CM)),
        "is_extreme_cold": _flag(t < F.lit(EXTREME_COLD_C)),
        "is_high_wind": _flag(w > F.lit(HIGH_WIND_KPH)),
    }


def weather_severity() -> Column:
    """Weighted flag sum clipped to [0, 5]; expects the flag columns to exist."""
    total = None
    for name, weight in SEVERITY_WEIGHTS.items():
        term = F.col(name) * F.lit(weight)
        total = term if total is None else total + term
    return F.greatest(F.lit(0), F.least(F.lit(SEVERITY_MAX), total)).cast("int")
