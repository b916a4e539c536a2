"""Two-hour training windows, route thresholds, labels, features and encoders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.calendar import time_period
from headway.operators.cells import FIRST, as_cells, delay_sum, is_cells
from headway.operators.ordinal import exact_quantile
from headway.operators.quantiles import grouped_quantiles, ratio

# The model's feature vector, in order.
FEATURES = [
    "hour", "day_of_week", "month", "is_weekend", "is_rush_hour",
    "route_mean_delay", "route_p95_delay", "route_sig_pct",
    "route_weather_sensitivity", "route_rush_sensitivity",
    "temp_c", "precip_mm", "snow_cm", "wind_kph",
    "weather_severity", "is_precipitation", "is_snow",
    "is_extreme_cold", "is_high_wind",
    "route_enc", "time_period_enc",
]

# Route statistics used as features (source column -> feature).
ROUTE_FEATURES = {
    "mean_delay_min": "route_mean_delay",
    "p95_delay_min": "route_p95_delay",
    "significant_delay_pct": "route_sig_pct",
    "weather_sensitivity_precip": "route_weather_sensitivity",
    "rush_hour_sensitivity": "route_rush_sensitivity",
}

MIN_WINDOW_INCIDENTS = 3
ROUTE_QUANTILE = 0.60
MAX_ON_TIME_SHARE = 0.70


def route_p60(delays: DataFrame, q: float = ROUTE_QUANTILE, selection: bool = False) -> DataFrame:
    """Per-route quantile of delay_min with linear interpolation (exact)."""
    return grouped_quantiles(as_cells(delays), ["route"], {"route_p60_delay": q}, selection)


def window_aggregates(delays: DataFrame, ordinal: str = "event_id", min_incidents: int = MIN_WINDOW_INCIDENTS) -> DataFrame:
    """Aggregate incidents (or cells) to (route, date, 2-hour bucket).

    "First" values follow the input order given by ``ordinal`` (nulls skipped),
    via ``min_by`` so the result does not depend on partitioning.  Weather is
    summed per incident row, as the published model does.
    """
    ordinal = FIRST if is_cells(delays) else ordinal
    df = as_cells(delays).withColumns({"hour_bucket": (F.floor(F.col("hour") / 2) * 2).cast("int"), "delay": delay_sum()})

    def first(c):
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ordinal)))

    agg = df.groupBy("route", "date", "hour_bucket").agg(
        F.sum("n").alias("incidents"),
        ratio("delay").alias("avg_delay"),
        ratio("is_on_time").alias("on_time_pct"),
        first("is_weekend").alias("is_weekend"),
        first("day_of_week").alias("day_of_week"),
        first("month").alias("month"),
        F.max("is_rush_hour").alias("is_rush_hour"),
        ratio("temp_c").alias("temp_c"),
        F.sum("precip_mm").alias("precip_mm"),
        F.sum("snow_cm").alias("snow_cm"),
        ratio("wind_kph").alias("wind_kph"),
        F.max("weather_severity").alias("weather_severity"),
        F.max("is_precipitation").alias("is_precipitation"),
        F.max("is_snow").alias("is_snow"),
        F.max("is_extreme_cold").alias("is_extreme_cold"),
        F.max("is_high_wind").alias("is_high_wind"),
        # time_period is a function of the hour: take the first hour (an integer
        # buffer keeps the aggregate on the code-generated path) and map it
        first("hour").alias("_first_hour"),
    )
    agg = agg.withColumn("time_period", time_period(F.col("_first_hour"))).drop("_first_hour")
    agg = agg.withColumn("hour", F.col("hour_bucket"))
    return agg.filter(F.col("incidents") >= F.lit(min_incidents))


def training_windows(
    delays: DataFrame,
    ordinal: str = "event_id",
    min_incidents: int = MIN_WINDOW_INCIDENTS,
    quantile: float = ROUTE_QUANTILE,
    max_on_time: float = MAX_ON_TIME_SHARE,
) -> DataFrame:
    """Windows labelled ``degraded`` = avg delay above the route's p60 AND on-time share below 0.70.

    A route without a p60 takes the median of the window means (a scalar subquery).
    """
    win = window_aggregates(delays, ordinal, min_incidents)
    return label_windows(win, route_p60(delays, quantile), max_on_time)


def label_windows(
    win: DataFrame, p60: DataFrame, max_on_time: float = MAX_ON_TIME_SHARE, fill: str = "always"
) -> DataFrame:
    """Join the route thresholds to aggregated windows and label them.

    Pass a stored ``win`` so the fallback median reads the window table, not the
    incidents it was built from.  ``fill="auto"`` first asks (one anti-join of two
    small stored tables) whether any window route lacks a threshold, and computes
    the fallback median only then; the result is the same either way.
    """
    out = win.join(p60, "route", "left")
    needed = fill == "always" or win.select("route").join(p60.select("route"), "route", "left_anti").limit(1).count() > 0
    if needed:
        median = exact_quantile(win, "avg_delay", 0.5).scalar()
        out = out.withColumn("route_p60_delay", F.coalesce(F.col("route_p60_delay"), median))
    label = (F.col("avg_delay") > F.col("route_p60_delay")) & (F.col("on_time_pct") < F.lit(max_on_time))
    return out.withColumn("degraded", label.cast("int"))


def encoder_table(df: DataFrame, column: str, fill: str | None = None) -> DataFrame:
    """Sorted-label encoder: distinct labels in code-point order -> 0..n-1.

    The ranking window runs on the distinct labels only (a categorical domain).
    """
    src = F.coalesce(F.col(column).cast("string"), F.lit(fill)) if fill else F.col(column).cast("string")
    labels = df.select(src.alias("label")).distinct()
    return labels.select("label", (F.dense_rank().over(Window.orderBy("label")) - 1).cast("int").alias("code"))


def training_features(windows: DataFrame, route_risk: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Join route statistics, impute, encode.  Returns (features, route_encoder, period_encoder).

    Missing route statistics take the median over the window rows (0 if none);
    any remaining null feature becomes 0.
    """
    stats = route_risk.select("route", *[F.col(k).alias(v) for k, v in ROUTE_FEATURES.items()])
    df = windows.join(stats, "route", "left")
    # one row for each route: its statistics and its number of windows
    per_route = windows.groupBy("route").agg(F.count(F.lit(1)).alias("n")).join(stats, "route", "left")
    medians = per_route.select(F.struct(*[F.percentile(c, F.lit(0.5), F.col("n")).alias(c) for c in ROUTE_FEATURES.values()]).alias("m")).scalar()
    df = df.withColumn("_med", medians)
    df = df.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_med.{c}"), F.lit(0.0)) for c in ROUTE_FEATURES.values()}
    ).drop("_med")
    route_enc = encoder_table(df, "route")
    period_enc = encoder_table(df, "time_period", fill="Unknown")
    df = df.join(route_enc.withColumnRenamed("label", "route").withColumnRenamed("code", "route_enc"), "route", "left")
    df = df.withColumn("_tp", F.coalesce(F.col("time_period"), F.lit("Unknown")))
    df = df.join(
        period_enc.withColumnRenamed("label", "_tp").withColumnRenamed("code", "time_period_enc"), "_tp", "left"
    ).drop("_tp")
    df = df.na.fill(0, subset=FEATURES)
    return df, route_enc, period_enc


def population_scaling(features: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """(feature, mean, std): mean and population standard deviation (the standardiser's fit),
    one aggregate over the rows."""
    v = {c: F.col(c).cast("double") for c in cols}
    one = features.agg(*[F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")).alias(c) for c, x in v.items()])
    long = one.select(F.explode(F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c))])).alias("feature", "s"))
    return long.select("feature", "s.mean", "s.std")
