"""Dashboard measures and visuals, as queries over the reporting tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.numeric import r
from headway.operators.tables import COUNTED_CATEGORIES

# The on-time target line and the dashboard's week-day columns.
ON_TIME_TARGET = 80.0
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
HIGH_RISK_TIERS = ["Critical", "High"]
DEFAULT_ALERT_FILTER = ["Warning", "Alert"]
KPI_PLACES = 6


def kpi_summary(route_daily: DataFrame, target: float = ON_TIME_TARGET) -> DataFrame:
    """Network on-time % (mean of route-days), total delay hours, routes with a day below target."""
    return route_daily.agg(
        r(F.avg("on_time_pct"), KPI_PLACES).alias("network_on_time_pct"),
        r(F.sum("total_delay_hrs"), 2).alias("total_delay_hours"),
        F.countDistinct(F.when(F.col("on_time_pct") < F.lit(target), F.col("route"))).alias("routes_below_target"),
    )


def _uplift(treated, control):
    return F.when(control.isNull() | (control == 0), F.lit(0.0)).otherwise(
        (F.coalesce(treated, F.lit(0.0)) - control) / control
    )


def delay_uplift(route_daily: DataFrame) -> DataFrame:
    """Rain and snow uplift of mean route-day delay; 0 when the baseline is 0 or empty."""
    d = F.col("avg_delay_min")
    agg = route_daily.agg(
        F.avg(F.when(F.col("had_precipitation") == 1, d)).alias("rain"),
        F.avg(F.when(F.col("had_precipitation") == 0, d)).alias("dry"),
        F.avg(F.when(F.col("had_snow") == 1, d)).alias("snow"),
        F.avg(F.when((F.col("had_precipitation") == 0) & (F.col("had_snow") == 0), d)).alias("clear"),
    )
    return agg.select(
        r(_uplift(F.col("rain"), F.col("dry")), KPI_PLACES).alias("rain_delay_uplift"),
        r(_uplift(F.col("snow"), F.col("clear")), KPI_PLACES).alias("snow_delay_uplift"),
    )


def high_risk_route_count(route_risk: DataFrame, tiers=HIGH_RISK_TIERS) -> DataFrame:
    return route_risk.filter(F.col("risk_tier").isin(tiers)).agg(F.countDistinct("route").alias("high_risk_routes"))


def network_trend(network: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Network on-time line with its 30-day rolling line, within a date-range slicer."""
    out = network.select("date", "network_on_time_pct", "rolling_30d_on_time_pct")
    if start is not None:
        out = out.filter(F.col("date") >= F.lit(start))
    if end is not None:
        out = out.filter(F.col("date") <= F.lit(end))
    return out


def monthly_delay_hours(network: DataFrame) -> DataFrame:
    return network.groupBy("year_month").agg(r(F.sum("total_delay_hrs"), 2).alias("total_delay_hrs"))


def route_kpis(route_daily: DataFrame, route_risk: DataFrame, route: str | None = None) -> DataFrame:
    """Per route: mean of daily delay, on-time and p95, plus the route's rain sensitivity.

    The dashboard shows one route (a slicer); without ``route`` every route is computed.
    """
    rd = route_daily if route is None else route_daily.filter(F.col("route") == route)
    k = rd.groupBy("route").agg(
        r(F.avg("avg_delay_min"), KPI_PLACES).alias("avg_delay_min"),
        r(F.avg("on_time_pct"), KPI_PLACES).alias("on_time_pct"),
        r(F.avg("p95_delay_min"), KPI_PLACES).alias("p95_delay_min"),
    )
    return k.join(route_risk.select("route", "weather_sensitivity_precip"), "route", "left")


def route_trend(route_daily: DataFrame, route: str | None = None, target: float = ON_TIME_TARGET) -> DataFrame:
    rd = route_daily if route is None else route_daily.filter(F.col("route") == route)
    return rd.select("route", "date", "on_time_pct", "rolling_7d_on_time_pct", F.lit(target).alias("target"))


def hour_heatmap(route_hourly: DataFrame, route: str | None = None) -> DataFrame:
    """time_period x hour matrix of mean avg_delay_min (columns h00..h23)."""
    rh = route_hourly if route is None else route_hourly.filter(F.col("route") == route)
    p = rh.groupBy("time_period").pivot("hour", list(range(24))).agg(F.avg("avg_delay_min"))
    return p.select("time_period", *[r(F.col(str(h)), KPI_PLACES).alias(f"h{h:02d}") for h in range(24)])


def category_breakdown(route_daily: DataFrame) -> DataFrame:
    """The four category count columns as rows, summed."""
    cols = [f"{c.lower()}_incidents" for c in COUNTED_CATEGORIES]
    long = route_daily.unpivot([], cols, "category", "incidents")
    return long.groupBy("category").agg(F.sum("incidents").cast("long").alias("incidents"))


def weather_summary(weather_impact: DataFrame) -> DataFrame:
    out = weather_impact.select(
        "weather_condition", "severity_bucket", "avg_delay_min", "on_time_pct", "significant_delay_pct", "total_incidents"
    )
    return out.orderBy(F.col("avg_delay_min").desc())


def precip_scatter(route_daily: DataFrame) -> DataFrame:
    return route_daily.select("route", "date", "total_precip_mm", "avg_delay_min", "total_incidents")


def ontime_by_severity(weather_impact: DataFrame) -> DataFrame:
    return weather_impact.groupBy("severity_bucket").agg(r(F.avg("on_time_pct"), KPI_PLACES).alias("on_time_pct"))


def top_risk_routes(route_risk: DataFrame, k: int = 10) -> DataFrame:
    """Top-k routes by risk score (route name breaks ties)."""
    return route_risk.select("route", "risk_score", "risk_tier").orderBy(
        F.col("risk_score").desc(), F.col("route").asc()
    ).limit(k)


def star_daily_risk(route_daily: DataFrame, route_risk: DataFrame) -> DataFrame:
    """Many-to-one relationship route_daily -> route_risk_scores on route."""
    rr = route_risk.select("route", "risk_score", "risk_tier", "risk_rank")
    return route_daily.select("route", "date", "on_time_pct", "avg_delay_min").join(rr, "route", "left")


def star_hourly_risk(route_hourly: DataFrame, route_risk: DataFrame) -> DataFrame:
    """Many-to-one relationship route_hourly -> route_risk_scores on route."""
    rr = route_risk.select("route", "risk_score", "risk_tier", "risk_rank")
    return route_hourly.select("route", "hour", "time_period", "avg_delay_min", "on_time_pct").join(rr, "route", "left")


def star_forecast_risk(summary: DataFrame, route_risk: DataFrame) -> DataFrame:
    """Many-to-one relationship tomorrow_forecast -> route_risk_scores on route."""
    rr = route_risk.select("route", "risk_score", "risk_rank")
    return summary.select("route", "date", "max_alert_score", "alert_level").join(rr, "route", "left")


def top_route_days(summary: DataFrame, k: int = 15) -> DataFrame:
    out = summary.select(
        "date", "day_name", "route", "max_degradation_prob", "max_alert_score", "alert_level", "weather_condition", "risk_tier"
    )
    return out.orderBy(
        F.col("max_degradation_prob").desc(), F.col("max_alert_score").desc(), F.col("date").asc(), F.col("route").asc()
    ).limit(k)


def alert_matrix(summary: DataFrame, route_risk: DataFrame, k: int = 20) -> DataFrame:
    """Route x weekday matrix of the max alert score, for the top-k routes by risk."""
    top = top_risk_routes(route_risk, k).select("route")
    s = summary.join(top, "route", "left_semi")
    return s.groupBy("route").pivot("day_name", DAY_NAMES).agg(F.max("max_alert_score"))


def alert_level_counts(summary: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Distinct routes per alert level and date (``as_of`` picks one date, as the dashboard does)."""
    s = summary if as_of is None else summary.filter(F.col("date") == F.lit(as_of))
    return s.groupBy("date", "alert_level").agg(F.countDistinct("route").alias("routes"))


def risk_by_day(summary: DataFrame, places: int = 10) -> DataFrame:
    return summary.groupBy("date").agg(r(F.avg("max_degradation_prob"), places).alias("avg_max_degradation_prob"))


def alert_filter(summary: DataFrame, levels=DEFAULT_ALERT_FILTER) -> DataFrame:
    return summary.filter(F.col("alert_level").isin(levels))
