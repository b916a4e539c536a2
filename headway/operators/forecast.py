"""Seven-day forecast: route x forecast-hour grid, alert scoring, daily summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import calendar as cal
from headway.functions.numeric import r
from headway.operators.joins import checked_broadcast
from headway.operators.windows import ROUTE_FEATURES

# Alert score weights, and right-closed alert bins
# (-0.001, 0.25] Normal, (0.25, 0.45] Watch, (0.45, 0.65] Warning, (0.65, 1.0] Alert;
# anything outside has no level.
ALERT_PROB_WEIGHT = 0.6
ALERT_RISK_WEIGHT = 0.4
ALERT_LOW = -0.001
ALERT_LEVELS = [("Normal", 0.25), ("Watch", 0.45), ("Warning", 0.65), ("Alert", 1.0)]

FORECAST_WEATHER = [
    "temp_c", "precip_mm", "snow_cm", "wind_kph", "weather_severity",
    "is_precipitation", "is_snow", "is_extreme_cold", "is_high_wind", "weather_condition",
]


def forecast_grid(
    route_risk: DataFrame,
    forecast_weather: DataFrame,
    route_encoder: DataFrame,
    period_encoder: DataFrame,
) -> DataFrame:
    """Every route x every forecast hour, with the model's features.

    Every forecast row meets every route, whatever its time of day: the forecast's
    times (a fixed horizon; 168 hours) are gathered in one array by a scalar subquery, each
    route row expands to them and meets the rows of that time in an equi-join.
    hour := 2-hour bucket start; time_period from the real hour; rush from the
    bucket start; calendar fields from the forecast timestamp.
    """
    fw = forecast_weather.select("datetime", *FORECAST_WEATHER)
    times = fw.agg(F.collect_set("datetime").alias("t")).select("t").scalar()
    routes = route_risk.select(
        F.col("route").cast("string").alias("route"),
        *[F.col(k).alias(v) for k, v in ROUTE_FEATURES.items()],
        F.col("risk_score").cast("double").alias("risk_score"),
        F.col("risk_tier").cast("string").alias("risk_tier"),
    )
    grid = routes.withColumn("datetime", F.explode(times)).join(checked_broadcast(fw), "datetime", "inner")
    real_hour = F.hour("datetime").cast("int")
    hb = (F.floor(real_hour / 2) * 2).cast("int")
    grid = grid.withColumns(
        {
            "date": F.to_date("datetime"),
            "day_name": cal.day_name("datetime"),
            "hour": hb,
            "time_period": cal.time_period(real_hour),
            "hour_bucket": hb,
            "day_of_week": cal.day_of_week_mon0("datetime"),
            "month": F.month("datetime").cast("int"),
            "is_weekend": cal.is_weekend("datetime"),
            "is_rush_hour": cal.is_rush_hour(hb),
        }
    )
    renc = route_encoder.select(F.col("label").alias("route"), F.col("code").alias("route_enc"))
    grid = grid.join(renc, "route", "left").withColumn("route_enc", F.coalesce("route_enc", F.lit(-1)).cast("int"))
    unknown = period_encoder.filter(F.col("label") == "Unknown").select(F.max("code")).scalar()
    penc = period_encoder.select(F.col("label").alias("time_period"), F.col("code").alias("_penc"))
    grid = grid.join(penc, "time_period", "left").withColumn(
        "time_period_enc", F.coalesce(F.col("_penc"), unknown, F.lit(0)).cast("int")
    ).drop("_penc")
    return grid.na.fill(0, subset=list(ROUTE_FEATURES.values()))


def alert_level(score: Column) -> Column:
    expr = None
    lo = ALERT_LOW
    for label, hi in ALERT_LEVELS:
        cond = (score > F.lit(lo)) & (score <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        lo = hi
    return expr


def alert_ordinal(level: Column) -> Column:
    expr = None
    for i, (label, _) in enumerate(ALERT_LEVELS):
        expr = F.when(level == label, F.lit(i)) if expr is None else expr.when(level == label, F.lit(i))
    return expr


def score_alerts(scored_grid: DataFrame, prob_col: str = "degradation_prob", sort: bool = True) -> DataFrame:
    """alert_score = round(0.6 * prob + 0.4 * risk_score, 4) and its level."""
    s = r(F.lit(ALERT_PROB_WEIGHT) * F.col(prob_col) + F.lit(ALERT_RISK_WEIGHT) * F.col("risk_score"), 4)
    out = scored_grid.withColumnRenamed(prob_col, "degradation_prob").withColumn("alert_score", s)
    out = out.withColumn("alert_level", alert_level(F.col("alert_score")))
    return out.orderBy(F.col("date").asc(), F.col("alert_score").desc()) if sort else out


def forecast_summary(alerts: DataFrame, sort: bool = True) -> DataFrame:
    """Per (date, day_name, route): max probability, max alert score, modal alert
    level (most hours; ties -> least severe), and the weather condition and risk
    tier at the highest-scoring hour (earliest hour on ties).

    Two small aggregations: per level, then per route-day.  A level that is not one of
    the alert bins counts as more severe than all of them; hours without one are skipped.
    """
    keys = ["date", "day_name", "route"]
    last = F.lit("9999-12-31").cast("timestamp_ntz")
    peak = F.struct(F.col("alert_score"), (last - F.col("datetime").cast("timestamp_ntz")).alias("left"), "weather_condition", "risk_tier")
    per_level = alerts.groupBy(*keys, "alert_level").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("degradation_prob").alias("_p"),
        F.max("alert_score").alias("_a"),
        F.max(peak).alias("_peak"),
    )
    rank = F.coalesce(alert_ordinal(F.col("alert_level")), F.lit(len(ALERT_LEVELS)))
    most = F.when(F.col("alert_level").isNotNull(), F.struct(F.col("_n"), -rank, F.col("alert_level").alias("level")))
    out = per_level.groupBy(*keys).agg(
        F.max("_p").alias("max_degradation_prob"),
        F.max("_a").alias("max_alert_score"),
        F.max(most).alias("_mode"),
        F.max("_peak").alias("_peak"),
    )
    out = out.select(
        *keys,
        "max_degradation_prob",
        "max_alert_score",
        F.col("_mode.level").alias("alert_level"),
        F.col("_peak.weather_condition").alias("weather_condition"),
        F.col("_peak.risk_tier").alias("risk_tier"),
    )
    return out.orderBy(F.col("date").asc(), F.col("max_alert_score").desc()) if sort else out
