"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the driver's tables whole (``events`` as the incident log,
``orders`` as hourly weather of many stations) and builds its result with the library's
operators.  Model-backed keys live in :mod:`headway.plans.model_queries`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import dashboard as db
from headway.operators import tables
from headway.operators.clean import (
    add_calendar,
    add_reliability_flags,
    categorise_incidents,
    clean_incidents,
    normalise_headers,
)
from headway.operators.fallback import fallback_from_stats
from headway.operators.forecast import forecast_grid, forecast_summary, score_alerts
from headway.operators.metrics import average_precision, brier, roc_auc, stratified_folds
from headway.operators.windows import (
    FEATURES,
    population_scaling,
    label_windows,
    route_p60,
    training_features,
    training_windows,
)
from headway.functions.numeric import r
from headway.functions.weather import FLAG_COLUMNS
from headway.sources import fixtures as fx
from headway.sources.weather_json import explode_hourly
from headway.plans.io_queries import IO_QUERIES
from headway.plans.model_queries import COMPANIONS, MODEL_QUERIES
from headway.plans.stages import stages

Query = Callable[[SparkSession, str], DataFrame]

DELAYS_COLUMNS = [
    "event_id", "station", "route", "date", "hour", "delay_min", "incident_category",
    "day_of_week", "day_name", "month", "is_weekend", "is_rush_hour", "time_period",
    "is_on_time", "is_significant", "is_severe",
    "temp_c", "precip_mm", "snow_cm", "wind_kph", "weather_condition", "weather_severity", *FLAG_COLUMNS,
]


# ---------------------------------------------------------------- shared inputs
def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).delays


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).weather


def risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).route_risk


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).windows


def features(spark: SparkSession, sf_dir: str):
    st = stages(spark, sf_dir)
    return st.features, st.route_encoder, st.period_encoder


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).grid


def alerts(spark: SparkSession, sf_dir: str, sort: bool = True) -> DataFrame:
    a = stages(spark, sf_dir).standin_alerts
    return a.orderBy(F.col("date").asc(), F.col("alert_score").desc()) if sort else a


def summary(spark: SparkSession, sf_dir: str, sort: bool = True) -> DataFrame:
    s = stages(spark, sf_dir).standin_summary
    return s.orderBy(F.col("date").asc(), F.col("max_alert_score").desc()) if sort else s


def metric_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic scores with ties for the metric jobs: (delay % 17) / 17 vs the rain flag."""
    d = delays(spark, sf_dir)
    return d.select((F.col("delay_min") % 17 / F.lit(17.0)).alias("score"), F.col("is_precipitation").alias("label"))


# ---------------------------------------------------------------- sources, cleaning, weather
def q_weather_explode(spark, sf_dir):
    return explode_hourly(fx.hourly_weather_documents(spark, sf_dir))


def q_forecast_explode(spark, sf_dir):
    return explode_hourly(fx.forecast_documents(spark, sf_dir), truncate_date=True)


CLEAN_COLUMNS = [
    "_id", "date", "route", "hour", "delay_min", "gap_min", "incident", "incident_category", "day",
    "location", "direction", "vehicle_id", "day_of_week", "day_name", "month", "month_name", "week",
    "is_weekend", "is_rush_hour", "time_period", "is_on_time", "is_significant", "is_severe",
]


def q_clean_incidents(spark, sf_dir):
    return clean_incidents(fx.raw_incidents_from_events(spark, sf_dir)).select(*CLEAN_COLUMNS)


def q_calendar_features(spark, sf_dir):
    inc = add_calendar(fx.incidents_from_events(spark, sf_dir))
    return inc.select(
        "event_id", "date", "hour", "day_of_week", "day_name", "month", "month_name", "week",
        "is_weekend", "is_rush_hour", "time_period",
    )


def q_reliability_flags(spark, sf_dir):
    inc = add_reliability_flags(fx.incidents_from_events(spark, sf_dir))
    return inc.select("event_id", "delay_min", "is_on_time", "is_significant", "is_severe")


def q_incident_categories(spark, sf_dir):
    raw = normalise_headers(fx.raw_incidents_from_events(spark, sf_dir))
    return categorise_incidents(raw).select("_id", "incident", "incident_category")


def q_weather_conditions(spark, sf_dir):
    return weather(spark, sf_dir).select("station", "date", "hour", "weather_code", "weather_condition")


def q_weather_severity(spark, sf_dir):
    return weather(spark, sf_dir).select(
        "station", "date", "hour", "temp_c", "precip_mm", "snow_cm", "wind_kph", *FLAG_COLUMNS, "weather_severity"
    )


def q_delays_weather_join(spark, sf_dir):
    return delays(spark, sf_dir).select(*DELAYS_COLUMNS)


def q_weather_match_rate(spark, sf_dir):
    return stages(spark, sf_dir).match_rate


# ---------------------------------------------------------------- the five tables
def q_route_daily(spark, sf_dir):
    return tables.route_daily(stages(spark, sf_dir).cells)


def q_route_hourly(spark, sf_dir):
    return tables.route_hourly(stages(spark, sf_dir).cells)


def q_weather_impact(spark, sf_dir):
    return tables.weather_impact(stages(spark, sf_dir).cells)


def q_network_summary(spark, sf_dir):
    return tables.network_summary(stages(spark, sf_dir).cells)


def q_route_risk_scores(spark, sf_dir):
    return tables.route_risk_from_stats(stages(spark, sf_dir).route_stats)


def q_route_sensitivity(spark, sf_dir):
    return tables.route_sensitivity(stages(spark, sf_dir).cells)


def q_route_risk_fallback(spark, sf_dir):
    return fallback_from_stats(stages(spark, sf_dir).fallback_stats)


# ---------------------------------------------------------------- training data
def q_route_p60(spark, sf_dir):
    return route_p60(delays(spark, sf_dir))


def q_training_windows(spark, sf_dir):
    st = stages(spark, sf_dir)
    return label_windows(st.window_aggregates, st.route_p60)


def q_training_features(spark, sf_dir):
    f, _, _ = training_features(windows(spark, sf_dir), risk(spark, sf_dir))
    return f.select("route", "date", "time_period", *FEATURES, "degraded")


def q_label_encoding(spark, sf_dir):
    _, renc, penc = training_features(windows(spark, sf_dir), risk(spark, sf_dir))
    return renc.select(F.lit("route").alias("encoder"), "label", "code").unionByName(
        penc.select(F.lit("time_period").alias("encoder"), "label", "code")
    )


def q_feature_scaling(spark, sf_dir):
    f, _, _ = features(spark, sf_dir)
    s = population_scaling(f)
    return s.select("feature", r(F.col("mean"), 6).alias("mean"), r(F.col("std"), 6).alias("std"))


def q_run_counts(spark, sf_dir):
    d = delays(spark, sf_dir)
    w = windows(spark, sf_dir)
    wstats = w.select(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.sum("degraded").cast("long").alias("k"), F.avg("degraded").alias("rate")
        ).alias("w")
    ).scalar()
    return d.agg(F.count(F.lit(1)).alias("incidents"), F.countDistinct("route").alias("routes")).select(
        "incidents",
        "routes",
        wstats.getField("n").alias("windows"),
        wstats.getField("k").alias("degraded_windows"),
        wstats.getField("rate").alias("base_degradation_rate"),
    )


def q_fold_assignment(spark, sf_dir):
    w = windows(spark, sf_dir).select("route", "date", "hour_bucket", "degraded")
    return stratified_folds(w, "degraded", ["route", "date", "hour_bucket"], k=5, seed=42)


def q_auc_metric(spark, sf_dir):
    return roc_auc(metric_scores(spark, sf_dir))


def q_average_precision(spark, sf_dir):
    return average_precision(metric_scores(spark, sf_dir))


def q_brier_score(spark, sf_dir):
    return brier(metric_scores(spark, sf_dir))


# ---------------------------------------------------------------- forecast
def q_forecast_grid(spark, sf_dir):
    st = stages(spark, sf_dir)
    g = forecast_grid(st.route_risk, st.forecast_weather, st.route_encoder, st.period_encoder)
    return g.select(
        "route", "datetime", "date", "day_name", "hour", "time_period", "day_of_week", "month",
        "is_weekend", "is_rush_hour", "route_mean_delay", "route_p95_delay", "route_sig_pct",
        "route_weather_sensitivity", "route_rush_sensitivity", "temp_c", "precip_mm", "snow_cm",
        "wind_kph", "weather_severity", "is_precipitation", "is_snow", "is_extreme_cold", "is_high_wind",
        "weather_condition", "route_enc", "time_period_enc", "risk_score", "risk_tier",
    )


def q_forecast_alerts(spark, sf_dir):
    a = score_alerts(grid(spark, sf_dir).withColumn("degradation_prob", F.col("hour") / F.lit(24.0)))
    return a.select(
        "route", "datetime", "date", "hour", "degradation_prob", "risk_score", "alert_score", "alert_level"
    )


def q_forecast_summary(spark, sf_dir):
    return forecast_summary(alerts(spark, sf_dir, sort=False))


def q_top15_route_days(spark, sf_dir):
    return db.top_route_days(summary(spark, sf_dir, sort=False), 15)


def q_alert_matrix(spark, sf_dir):
    return db.alert_matrix(summary(spark, sf_dir, sort=False), risk(spark, sf_dir), 20)


def q_alert_level_counts(spark, sf_dir):
    return db.alert_level_counts(summary(spark, sf_dir, sort=False))


def q_risk_by_day(spark, sf_dir):
    return db.risk_by_day(summary(spark, sf_dir, sort=False))


def q_alert_filter(spark, sf_dir):
    return db.alert_filter(summary(spark, sf_dir, sort=False))


# ---------------------------------------------------------------- dashboard
def _rd(spark, sf_dir):
    return stages(spark, sf_dir).route_daily


def q_kpi_summary(spark, sf_dir):
    return db.kpi_summary(_rd(spark, sf_dir))


def q_delay_uplift(spark, sf_dir):
    return db.delay_uplift(_rd(spark, sf_dir))


def q_high_risk_route_count(spark, sf_dir):
    return db.high_risk_route_count(risk(spark, sf_dir))


def q_network_trend(spark, sf_dir):
    return db.network_trend(stages(spark, sf_dir).network_summary)


def q_monthly_delay_hours(spark, sf_dir):
    return db.monthly_delay_hours(stages(spark, sf_dir).network_summary)


def q_route_kpis(spark, sf_dir):
    return db.route_kpis(_rd(spark, sf_dir), risk(spark, sf_dir))


def q_route_trend(spark, sf_dir):
    return db.route_trend(_rd(spark, sf_dir))


def q_hour_heatmap(spark, sf_dir):
    return db.hour_heatmap(stages(spark, sf_dir).route_hourly)


def q_category_breakdown(spark, sf_dir):
    return db.category_breakdown(_rd(spark, sf_dir))


def q_weather_summary(spark, sf_dir):
    return db.weather_summary(stages(spark, sf_dir).weather_impact)


def q_precip_scatter(spark, sf_dir):
    return db.precip_scatter(_rd(spark, sf_dir))


def q_ontime_by_severity(spark, sf_dir):
    return db.ontime_by_severity(stages(spark, sf_dir).weather_impact)


def q_top10_risk_routes(spark, sf_dir):
    return db.top_risk_routes(risk(spark, sf_dir), 10)


def q_star_daily_risk(spark, sf_dir):
    return db.star_daily_risk(_rd(spark, sf_dir), risk(spark, sf_dir))


def q_star_hourly_risk(spark, sf_dir):
    return db.star_hourly_risk(stages(spark, sf_dir).route_hourly, risk(spark, sf_dir))


def q_star_forecast_risk(spark, sf_dir):
    return db.star_forecast_risk(summary(spark, sf_dir, sort=False), risk(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "weather_explode": q_weather_explode,
    "forecast_explode": q_forecast_explode,
    "clean_incidents": q_clean_incidents,
    "calendar_features": q_calendar_features,
    "reliability_flags": q_reliability_flags,
    "incident_categories": q_incident_categories,
    "weather_conditions": q_weather_conditions,
    "weather_severity": q_weather_severity,
    "delays_weather_join": q_delays_weather_join,
    "weather_match_rate": q_weather_match_rate,
    "route_daily": q_route_daily,
    "route_hourly": q_route_hourly,
    "weather_impact": q_weather_impact,
    "network_summary": q_network_summary,
    "route_risk_scores": q_route_risk_scores,
    "route_sensitivity": q_route_sensitivity,
    "route_risk_fallback": q_route_risk_fallback,
    "route_p60": q_route_p60,
    "training_windows": q_training_windows,
    "training_features": q_training_features,
    "label_encoding": q_label_encoding,
    "feature_scaling": q_feature_scaling,
    "run_counts": q_run_counts,
    "fold_assignment": q_fold_assignment,
    "auc_metric": q_auc_metric,
    "average_precision": q_average_precision,
    "brier_score": q_brier_score,
    "forecast_grid": q_forecast_grid,
    "forecast_alerts": q_forecast_alerts,
    "forecast_summary": q_forecast_summary,
    "top15_route_days": q_top15_route_days,
    "alert_matrix": q_alert_matrix,
    "alert_level_counts": q_alert_level_counts,
    "risk_by_day": q_risk_by_day,
    "alert_filter": q_alert_filter,
    "kpi_summary": q_kpi_summary,
    "delay_uplift": q_delay_uplift,
    "high_risk_route_count": q_high_risk_route_count,
    "network_trend": q_network_trend,
    "monthly_delay_hours": q_monthly_delay_hours,
    "route_kpis": q_route_kpis,
    "route_trend": q_route_trend,
    "hour_heatmap": q_hour_heatmap,
    "category_breakdown": q_category_breakdown,
    "weather_summary": q_weather_summary,
    "precip_scatter": q_precip_scatter,
    "ontime_by_severity": q_ontime_by_severity,
    "top10_risk_routes": q_top10_risk_routes,
    "star_daily_risk": q_star_daily_risk,
    "star_hourly_risk": q_star_hourly_risk,
    "star_forecast_risk": q_star_forecast_risk,
}

QUERIES.update(MODEL_QUERIES)
QUERIES.update(COMPANIONS)
QUERIES.update(IO_QUERIES)
