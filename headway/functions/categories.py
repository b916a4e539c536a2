"""Keyword and code mappings: incident categories and WMO weather codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Incident categories and their keywords, in matching order.
# A record belongs to the first category having a keyword that occurs in the
# incident text (case-insensitive substring); no match or no text -> "Other".
INCIDENT_CATEGORIES = [
    ("Mechanical", ["Mechanical", "Held By", "Vehicle Out of Service"]),
    ("Operator", ["Operator", "Late Leaving Garage", "Sign Availability"]),
    ("Traffic", ["Traffic", "Diversion", "Road Blocked", "Utilized Off Route"]),
    ("Passenger", ["Emergency Services", "Investigation", "Security",
                   "Injured or Ill Operator", "Injured or Ill Customer"]),
    ("Infrastructure", ["Cleaning", "General Delay", "Vision"]),
]
OTHER = "Other"

# WMO weather code -> condition.  Other integers -> "Other",
# missing / non-numeric -> "Unknown".
WMO_CONDITIONS = [
    ("Clear", [0]),
    ("Cloudy", [1, 2, 3]),
    ("Fog", [45, 48]),
    ("Drizzle", [51, 53, 55]),
    ("Rain", [61, 63, 65]),
    ("Snow", [71, 73, 75, 77]),
    ("Rain Showers", [80, 81, 82]),
    ("Snow Showers", [85, 86]),
    ("Thunderstorm", [95, 96, 99]),
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def incident_category(incident) -> Column:
    text = F.upper(_c(incident).cast("string"))
    expr = None
    for category, keywords in INCIDENT_CATEGORIES:
        hit = None
        for k in keywords:
            c = text.contains(k.upper())
            hit = c if hit is None else (hit | c)
        expr = F.when(hit, F.lit(category)) if expr is None else expr.when(hit, F.lit(category))
    return F.coalesce(expr, F.lit(OTHER))


def weather_condition(code) -> Column:
    c = _c(code)
    # numeric strings are read as numbers; fractional codes truncate like int()
    as_num = c.cast("string").try_cast("double")
    as_int = F.when(~F.isnan(as_num), as_num).cast("long")
    expr = F.when(as_int.isNull(), F.lit("Unknown"))
    for label, codes in WMO_CONDITIONS:
        expr = expr.when(as_int.isin(codes), F.lit(label))
    return expr.otherwise(F.lit("Other"))
