"""Incident cleaning: raw text columns -> typed, derived, categorised rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions import calendar as cal
from headway.functions.categories import incident_category
from headway.functions.numeric import parse_number

# Header variants -> canonical names (after lower-casing,
# trimming and replacing spaces by underscores).
RENAMES = {
    "report_date": "date",
    "min_delay": "delay_min",
    "min_gap": "gap_min",
    "vehicle": "vehicle_id",
}

# Date texts accepted, tried in order.  The first that parses wins.
DATE_FORMATS = [
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd",
    "M/d/yyyy",
    "M/d/yyyy H:mm",
    "d-MMM-yy",
    "d-MMM-yyyy",
]

MISSING_ROUTE = "NAN"


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trim, lower-case, spaces -> underscores (metadata only)."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def rename_variants(df: DataFrame) -> DataFrame:
    """Canonical names; if both a variant and its target exist, the target wins where set."""
    for src, dst in RENAMES.items():
        if src not in df.columns:
            continue
        if dst in df.columns:
            df = df.withColumn(dst, F.coalesce(F.col(dst), F.col(src))).drop(src)
        else:
            df = df.withColumnRenamed(src, dst)
    return df


def parse_dates(df: DataFrame, formats: list[str] = DATE_FORMATS) -> DataFrame:
    """``date`` -> DATE; rows whose date does not parse are dropped."""
    if "date" not in df.columns:
        raise ValueError("incident records need a date column (Date or Report Date)")
    dtype = df.schema["date"].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        parsed = F.to_date("date")
    else:
        txt = F.trim(F.col("date").cast("string"))
        parsed = F.to_date(F.coalesce(*[F.try_to_timestamp(txt, F.lit(f)) for f in formats]))
    return df.withColumn("date", parsed).filter(F.col("date").isNotNull())


def derive_hour(df: DataFrame) -> DataFrame:
    if "time" in df.columns:
        return df.withColumn("hour", cal.hour_from_time_text("time"))
    return df.withColumn("hour", F.lit(0))


def coerce_delay(df: DataFrame) -> DataFrame:
    """delay_min -> double, unreadable -> 0, negatives dropped."""
    if "delay_min" not in df.columns:
        raise ValueError("incident records need a delay column (Min Delay)")
    d = F.coalesce(parse_number("delay_min"), F.lit(0.0))
    return df.withColumn("delay_min", d).filter(F.col("delay_min") >= 0)


def add_calendar(df: DataFrame) -> DataFrame:
    """day_of_week (0=Mon), day_name, month, month_name, ISO week, weekend, rush hour, time period."""
    return df.withColumns(
        {
            "day_of_week": cal.day_of_week_mon0("date"),
            "day_name": cal.day_name("date"),
            "month": F.month("date").cast("int"),
            "month_name": cal.month_name("date"),
            "week": cal.iso_week("date"),
            "is_weekend": cal.is_weekend("date"),
            "is_rush_hour": cal.is_rush_hour("hour"),
            "time_period": cal.time_period("hour"),
        }
    )


def add_reliability_flags(
    df: DataFrame, on_time_below: float = 5.0, significant_from: float = 5.0, severe_from: float = 20.0
) -> DataFrame:
    d = F.col("delay_min")
    return df.withColumns(
        {
            "is_on_time": (d < F.lit(on_time_below)).cast("int"),
            "is_significant": (d >= F.lit(significant_from)).cast("int"),
            "is_severe": (d >= F.lit(severe_from)).cast("int"),
        }
    )


def categorise_incidents(df: DataFrame) -> DataFrame:
    if "incident" in df.columns:
        return df.withColumn("incident_category", incident_category("incident"))
    return df.withColumn("incident_category", F.lit("Other"))


def normalise_route(df: DataFrame) -> DataFrame:
    if "route" not in df.columns:
        return df
    txt = F.coalesce(F.col("route").cast("string"), F.lit("nan"))
    return df.withColumn("route", F.upper(F.regexp_replace(txt, r"^\s+|\s+$", "")))


def clean_incidents(raw: DataFrame) -> DataFrame:
    """Raw incident rows (any header spelling, text values) -> clean typed rows.

    One narrow projection + filter chain: no shuffle, runs where the data is.
    """
    df = rename_variants(normalise_headers(raw))
    df = parse_dates(df)
    df = derive_hour(df)
    df = coerce_delay(df)
    df = add_calendar(df)
    df = add_reliability_flags(df)
    df = categorise_incidents(df)
    return normalise_route(df)
