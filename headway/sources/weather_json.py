"""Hourly weather documents (parallel arrays under ``hourly``) -> one row per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# API field -> column name.
HOURLY_FIELDS = {
    "temperature_2m": "temp_c",
    "precipitation": "precip_mm",
    "snowfall": "snow_cm",
    "windspeed_10m": "wind_kph",
    "weathercode": "weather_code",
}

HOURLY_SCHEMA = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(T.StringType())),
                    T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
                    T.StructField("precipitation", T.ArrayType(T.DoubleType())),
                    T.StructField("snowfall", T.ArrayType(T.DoubleType())),
                    T.StructField("windspeed_10m", T.ArrayType(T.DoubleType())),
                    T.StructField("weathercode", T.ArrayType(T.LongType())),
                ]
            ),
        )
    ]
)


def read_hourly_json(spark: SparkSession, path: str) -> DataFrame:
    """Read one or many API documents (multi-line JSON) with a declared schema."""
    return spark.read.schema(HOURLY_SCHEMA).option("multiLine", True).json(path)


def explode_hourly(docs: DataFrame, truncate_date: bool = False) -> DataFrame:
    """Zip the parallel arrays of each document into rows (nulls kept), then derive
    datetime, date and hour, drop ``time`` and rename the measurements.

    Each document expands in place (``inline`` of ``arrays_zip``): no shuffle.  Columns
    beside ``hourly`` (a station, say) go with every row.
    """
    more = [c for c in docs.columns if c != "hourly"]
    h = F.col("hourly")
    zipped = F.arrays_zip(*[h.getField(f).alias(f) for f in ["time", *HOURLY_FIELDS]])
    rows = docs.select(*more, F.inline(zipped))
    ts = F.to_timestamp_ntz(F.col("time"))
    rows = rows.withColumn("datetime", ts)
    date = F.to_date("datetime")
    rows = rows.withColumns({"date": date, "hour": F.hour("datetime").cast("int")}).drop("time")
    rows = rows.withColumnsRenamed(HOURLY_FIELDS)
    rows = rows.withColumn("weather_code", F.col("weather_code").cast("int"))
    if truncate_date:
        rows = rows.withColumn("date", F.to_date(F.date_trunc("day", F.col("datetime"))))
    return rows.select(*more, "datetime", "date", "hour", *HOURLY_FIELDS.values())
