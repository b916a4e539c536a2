"""Stand-ins built from the driver's tables.

``events`` plays the incident log and ``orders`` the hour-indexed weather
measurements.  All rules here are projections and one bounded filter, so
every derived table grows with its source (see FIXTURES.md section 2).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fixture's calendar.  Incidents span 30 days from the epoch.
# Every order is one hour of weather at one station: station = o_orderkey div 720,
# hour index = o_orderkey mod 720.  An incident's station is event_id div 360; there
# are 1.5 orders for each event, so the stations of the last incidents have no
# weather.  The forecast is the mean over all stations for the seven days from
# FORECAST_START.
EPOCH = dt.date(2024, 1, 1)
PERIOD_DAYS = 30
STATION_HOURS = 24 * PERIOD_DAYS
EVENTS_PER_STATION = 360
FORECAST_START = dt.date(2024, 1, 10)
FORECAST_DAYS = 7

# A rare route so the ">= 10 incidents" rule has work to do.
RARE_ROUTE = "X1"
RARE_ROUTE_MOD = 1500
RARE_ROUTE_REM = 7

# Event type -> incident category of the fact-table stand-in.
EVENT_CATEGORY = [
    ("error", "Mechanical"),
    ("click", "Traffic"),
    ("view", "Passenger"),
    ("signup", "Operator"),
]

# WMO code chosen by o_custkey % 12.
CODE_BY_REM = [0, 1, 3, 45, 51, 61, 63, 71, 80, 85, 95, 99]
PRECIP_REMS = [4, 5, 6, 8, 10]
SNOW_REMS = [7, 9, 11]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _route(event_id: Column, user_id: Column) -> Column:
    return (
        F.when(event_id % RARE_ROUTE_MOD == RARE_ROUTE_REM, F.lit(RARE_ROUTE))
        .otherwise(F.concat(F.lit("R"), F.floor(F.sqrt(user_id)).cast("int").cast("string")))
    )


def _category(event_type: Column) -> Column:
    expr = None
    for et, cat in EVENT_CATEGORY:
        expr = F.when(event_type == et, F.lit(cat)) if expr is None else expr.when(event_type == et, F.lit(cat))
    return expr.otherwise(F.lit("Other"))


def incidents_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed incident rows: event_id (input ordinal), station, route, date, hour, delay_min, incident_category."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.floor(F.col("event_id") / EVENTS_PER_STATION).cast("int").alias("station"),
        _route(F.col("event_id"), F.col("user_id")).alias("route"),
        F.to_date("ts").alias("date"),
        F.hour("ts").cast("int").alias("hour"),
        F.floor(F.col("value") / F.lit(10.0)).cast("double").alias("delay_min"),
        _category(F.col("event_type")).alias("incident_category"),
    )


def _weather_measurements(orders: DataFrame) -> DataFrame:
    k = F.col("o_custkey")
    rem12 = k % 12
    code = None
    for i, c in enumerate(CODE_BY_REM):
        code = F.when(rem12 == i, F.lit(c)) if code is None else code.when(rem12 == i, F.lit(c))
    start = F.lit(dt.datetime.combine(EPOCH, dt.time())).cast("timestamp_ntz")
    at = (F.col("o_orderkey") % STATION_HOURS).cast("int")
    return orders.select(
        F.floor(F.col("o_orderkey") / STATION_HOURS).cast("int").alias("station"),
        (start + F.make_dt_interval(hours=at)).alias("datetime"),
        F.date_add(F.lit(EPOCH), F.floor(at / 24).cast("int")).alias("date"),
        (at % 24).cast("int").alias("hour"),
        ((k % 45).cast("double") - F.lit(18.0)).alias("temp_c"),
        F.when(rem12.isin(PRECIP_REMS), (k % 29).cast("double") * F.lit(0.25)).otherwise(F.lit(0.0)).alias("precip_mm"),
        F.when(rem12.isin(SNOW_REMS), (k % 13).cast("double") * F.lit(0.125)).otherwise(F.lit(0.0)).alias("snow_cm"),
        (k % 61).cast("double").alias("wind_kph"),
        code.cast("int").alias("weather_code"),
    )


def weather_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather: one row for each order, keyed by (station, date, hour)."""
    return _weather_measurements(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))


def forecast_weather_from_orders(
    spark: SparkSession, sf_dir: str, start: dt.date = FORECAST_START, days: int = FORECAST_DAYS
) -> DataFrame:
    """Seven-day forecast: for each hour of ``start`` .. ``start + days - 1`` the mean measurements
    of all stations and their largest weather code (at most 24 * days rows)."""
    w = weather_from_orders(spark, sf_dir)
    w = w.filter((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(start + dt.timedelta(days=days))))
    return w.groupBy("datetime", "date", "hour").agg(
        *[F.avg(c).alias(c) for c in ("temp_c", "precip_mm", "snow_cm", "wind_kph")], F.max("weather_code").alias("weather_code")
    )


# Incident phrases of the raw-file fixture, chosen per event type.
RAW_DIRECTIONS = ["N", "S", "E", "W"]


def raw_incidents_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incident log formatted back to raw text, as an open-data file would carry it.

    Headers use the published spelling (``Date``, ``Min Delay``...).  Dates are
    ``yyyy-MM-dd`` text with junk every 97th row; times are ``H:mm``, ``HH:mm`` or
    ``HH:mm:ss`` by event_id % 3 and ``nan`` every 37th row; delays are whole-minute
    text, ``n/a`` every 50th row and negative every 71st; routes are padded and mixed
    case, missing every 83rd row; incident text is missing every 89th row.
    """
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    route = _route(eid, F.col("user_id"))
    route_txt = (
        F.when(eid % 83 == 0, F.lit(None).cast("string"))
        .when(eid % 4 == 0, route)
        .when(eid % 4 == 1, F.lower(route))
        .when(eid % 4 == 2, F.concat(F.lit("  "), route, F.lit(" ")))
        .otherwise(F.concat(F.lit(" "), F.lower(route)))
    )
    date_txt = F.when(eid % 97 == 0, F.lit("not a date")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    time_txt = (
        F.when(eid % 37 == 0, F.lit("nan"))
        .when(eid % 3 == 0, F.date_format("ts", "H:mm"))
        .when(eid % 3 == 1, F.date_format("ts", "HH:mm"))
        .otherwise(F.date_format("ts", "HH:mm:ss"))
    )
    minutes = F.floor(F.col("value") / F.lit(10.0)).cast("long")
    delay_txt = (
        F.when(eid % 50 == 0, F.lit("n/a"))
        .when(eid % 71 == 0, F.concat(F.lit("-"), (minutes + 1).cast("string")))
        .otherwise(minutes.cast("string"))
    )
    et = F.col("event_type")
    incident = (
        F.when(eid % 89 == 0, F.lit(None).cast("string"))
        .when((et == "error") & (eid % 2 == 0), F.lit("Mechanical"))
        .when(et == "error", F.lit("Held By"))
        .when(et == "click", F.lit("Diversion"))
        .when((et == "view") & (eid % 4 == 0), F.lit("Injured or Ill Operator"))
        .when(et == "view", F.lit("Security"))
        .when(et == "signup", F.lit("Late Leaving Garage"))
        .when(eid % 3 == 0, F.lit("General Delay"))
        .when(eid % 3 == 1, F.lit("cleaning - unsanitary"))
        .otherwise(F.lit("Collision - Vehicle"))
    )
    direction = F.element_at(F.array(*[F.lit(d) for d in RAW_DIRECTIONS]), (eid % 4 + 1).cast("int"))
    return ev.select(
        eid.cast("string").alias("_id"),
        date_txt.alias("Date"),
        route_txt.alias("Route"),
        time_txt.alias("Time"),
        F.date_format("ts", "EEEE").alias("Day"),
        F.concat(F.lit("Stop "), (F.col("user_id") % 50).cast("string")).alias("Location"),
        incident.alias("Incident"),
        delay_txt.alias("Min Delay"),
        (minutes + 5).cast("string").alias("Min Gap"),
        direction.alias("Direction"),
        (F.col("user_id") + 1000).cast("string").alias("Vehicle"),
    )


def hourly_documents(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Weather rows shaped like the hourly JSON API: one document per day (and other ``keys``),
    ``hourly`` = struct of parallel arrays ordered by time.

    Groups are one day each (24 elements), so no group grows with the data.
    """
    rows = rows.select(
        *keys,
        F.struct(
            F.col("datetime").alias("ts"),
            F.date_format("datetime", "yyyy-MM-dd'T'HH:mm").alias("time"),
            F.col("temp_c").alias("temperature_2m"),
            F.col("precip_mm").alias("precipitation"),
            F.col("snow_cm").alias("snowfall"),
            F.col("wind_kph").alias("windspeed_10m"),
            F.col("weather_code").cast("long").alias("weathercode"),
        ).alias("h"),
    )
    per_day = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("h")).alias("hs"))
    return per_day.select(
        *[k for k in keys if k != "date"],
        F.struct(
            F.col("hs.time").alias("time"),
            F.col("hs.temperature_2m").alias("temperature_2m"),
            F.col("hs.precipitation").alias("precipitation"),
            F.col("hs.snowfall").alias("snowfall"),
            F.col("hs.windspeed_10m").alias("windspeed_10m"),
            F.col("hs.weathercode").alias("weathercode"),
        ).alias("hourly"),
    )


def hourly_weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole weather table as documents, one for each station and day."""
    return hourly_documents(weather_from_orders(spark, sf_dir), ["station", "date"])


def forecast_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast as documents, one for each day."""
    return hourly_documents(forecast_weather_from_orders(spark, sf_dir), ["date"])
