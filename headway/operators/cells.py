"""The roll-up of the fact table that every report is made from.

A cell is all incidents of one route, date, hour, category, weather situation and delay; it holds their
number, the sums of the measurements and the least input ordinal.  The reports' quantities all follow from
cells: counts, sums and shares add up, maxima are over key columns, an exact quantile needs (value, count)
only, and "first" values need the least ordinal.  So the fact table is scanned once, and what the reports
read is bounded by the calendar, the routes and the different delays, not by the incidents.

An incident row is a cell with n = 1: :func:`as_cells` lets every report take either.  Kept under a folder, cells
lie by date, so a new or corrected day rewrites its own partition only (:func:`refresh_cells`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.weather import FLAG_COLUMNS

#: Part of a cell's key where the fact table has them.
KEYS = [
    "route", "date", "hour", "time_period", "is_rush_hour", "is_weekend", "day_of_week", "month", "incident_category",
    "weather_condition", "weather_severity", *FLAG_COLUMNS,
]
#: Added up over a cell's incidents.
SUMS = ["is_on_time", "is_significant", "is_severe", "temp_c", "precip_mm", "snow_cm", "wind_kph"]
FIRST = "first_ordinal"


def is_cells(df: DataFrame) -> bool:
    return {"value", "n"} <= set(df.columns)


def as_cells(df: DataFrame) -> DataFrame:
    """Cells as they are; incident rows as cells of one incident each."""
    return df if is_cells(df) else df.withColumns({"value": F.col("delay_min"), "n": F.lit(1).cast("long")})


def build_cells(delays: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Cells of incident rows: KEYS, value (the delay), n, SUMS, and ``first_ordinal`` with an ``ordinal``.

    One partial (map-side) and one final hash aggregate over the rows; nulls of key columns are groups of
    their own, null measurements do not count into their sums.  An empty table gives no cells.
    """
    keys = [k for k in KEYS if k in delays.columns]
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(c).alias(c) for c in SUMS if c in delays.columns]
    aggs += [F.min(ordinal).alias(FIRST)] if ordinal else []
    d = delays.withColumn("date", F.col("date").cast("date"))
    return d.groupBy(*keys, F.col("delay_min").alias("value")).agg(*aggs)


def times(flag: Column | str) -> Column:
    """What a 0/1 (or boolean) key condition adds up to in a cell."""
    c = F.col(flag) if isinstance(flag, str) else flag
    return F.coalesce(c.cast("int"), F.lit(0)) * F.col("n")


def delay_sum() -> Column:
    return F.col("value") * F.col("n")


def store_cells(cells: DataFrame, path: str, only_days: bool = False) -> None:
    """Write cells by date; with ``only_days`` just the partitions of the dates they have are replaced."""
    mode = "dynamic" if only_days else "static"
    cells.repartition("date", F.pmod(F.hash("route"), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("date").parquet(path)


def refresh_cells(delays: DataFrame, path: str, days: list, ordinal: str | None = None) -> None:
    """Rebuild the cells of ``days`` from the fact table; every other day's partition stays as it is.

    The fact rows of other days are not read where the table is laid out by date.  A day that has no
    incidents any more keeps its old cells: rebuild the whole roll-up for that.
    """
    own = delays.where(F.col("date").cast("date").isin([F.lit(d).cast("date") for d in days]))
    store_cells(build_cells(own, ordinal), path, only_days=True)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("date", F.col("date").cast("date"))
