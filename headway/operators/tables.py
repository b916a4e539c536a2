"""The five reporting tables: route_daily, route_hourly, weather_impact,
network_summary, route_risk_scores (plus the sensitivity slice of the last).

All are partial (map-side) + final hash aggregations on their group keys over the
fact table or, in a run, over its stored cells (:mod:`headway.operators.cells`); exact quantiles come from
(group, value) counts (:mod:`headway.operators.quantiles`); windows and normalisation run only on the
reduced tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import calendar as cal
from headway.functions.numeric import r
from headway.operators.cells import as_cells, delay_sum, times
from headway.operators.quantiles import Quantile, ratio, reduced, summarise

# Incident categories counted per route-day.
COUNTED_CATEGORIES = ["Mechanical", "Traffic", "Passenger", "Operator"]

# Severity buckets over weather_severity.
SEVERITY_BUCKETS = [
    ("Clear / Mild", 0, 0),
    ("Light Adverse", 1, 2),
    ("Moderate Adverse", 3, 4),
]
SEVERITY_BUCKET_OTHER = "Severe Adverse"

# Risk-score weights and tier cut points (strictly greater than).
RISK_WEIGHTS = [
    ("sig_norm", 0.35),
    ("mean_norm", 0.30),
    ("p95_norm", 0.20),
    ("vol_norm", 0.15),
]
RISK_TIERS = [("Critical", 0.75), ("High", 0.55), ("Medium", 0.35)]
RISK_TIER_OTHER = "Low"

MIN_ROUTE_INCIDENTS = 10


FLAGS = ["is_on_time", "is_significant", "is_severe"]


def _sums(weather: list[str] = (), split: list[str] = ()) -> dict[str, Column]:
    """Sums every table needs: delay and flags, weather columns, and delay by 0/1 flag of ``split``."""
    out = {"delay": delay_sum(), **{f: F.col(f) for f in FLAGS}, **{w: F.col(w) for w in weather}}
    for f in split:
        for on in (0, 1):
            out[f"{f}_{on}_n"] = times(F.col(f) == on)
            out[f"{f}_{on}_delay"] = F.when(F.col(f) == on, delay_sum())
    return out


def _share(flag: str) -> Column:
    return ratio(flag) * F.lit(100)


def _cond_avg(flag: str, on: int) -> Column:
    return ratio(f"{flag}_{on}_delay", f"{flag}_{on}_n")


def severity_bucket(severity="weather_severity") -> Column:
    s = F.col(severity) if isinstance(severity, str) else severity
    expr = None
    for label, lo, hi in SEVERITY_BUCKETS:
        cond = s == lo if lo == hi else s.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(SEVERITY_BUCKET_OTHER))


def risk_tier(score: Column) -> Column:
    expr = None
    for label, cut in RISK_TIERS:
        expr = F.when(score > F.lit(cut), F.lit(label)) if expr is None else expr.when(score > F.lit(cut), F.lit(label))
    return expr.otherwise(F.lit(RISK_TIER_OTHER))


def route_daily(delays: DataFrame, sort: bool = True, selection: bool = False) -> DataFrame:
    """One row per (route, date): counts, delay statistics, weather, categories,
    7-row rolling means per route and the daily reliability rank."""
    d = as_cells(delays).withColumn("date", F.col("date").cast("date"))
    categories = {f"{c.lower()}_incidents": times(F.col("incident_category") == c) for c in COUNTED_CATEGORIES}
    maxima = ["is_weekend", "weather_severity", "is_precipitation", "is_snow", "is_extreme_cold"]
    rows = reduced(
        d, ["route", "date"],
        {**_sums(["temp_c", "precip_mm", "snow_cm", "wind_kph"]), **categories},
        {c: F.col(c) for c in maxima},
    )
    base = summarise(rows, ["route", "date"], {
        "is_weekend": F.max("is_weekend"),
        "total_incidents": F.sum("n"),
        "significant_delays": F.sum("is_significant"),
        "severe_delays": F.sum("is_severe"),
        "on_time_count": F.sum("is_on_time"),
        "avg_delay_min": r(ratio("delay"), 2),
        "median_delay_min": Quantile(0.5, 2),
        "max_delay_min": r(F.max("value"), 1),
        "p95_delay_min": Quantile(0.95, 1),
        "total_delay_hrs": r(F.sum("delay") / F.lit(60.0), 2),
        "on_time_pct": r(_share("is_on_time"), 2),
        "significant_delay_pct": r(_share("is_significant"), 2),
        "avg_temp_c": r(ratio("temp_c"), 1),
        "total_precip_mm": r(F.sum("precip_mm"), 1),
        "total_snow_cm": r(F.sum("snow_cm"), 1),
        "avg_wind_kph": r(ratio("wind_kph"), 1),
        "max_weather_severity": F.max("weather_severity"),
        "had_precipitation": F.max("is_precipitation"),
        "had_snow": F.max("is_snow"),
        "had_extreme_cold": F.max("is_extreme_cold"),
        **{k: F.sum(k) for k in categories},
    }, selection)
    labelled = base.withColumns(
        {
            "year_month": cal.year_month("date"),
            "day_of_week": cal.day_of_week_sun0("date"),
            "day_name": cal.day_name("date"),
        }
    )
    w7 = Window.partitionBy("route").orderBy("date").rowsBetween(-6, Window.currentRow)
    by_day = Window.partitionBy("date").orderBy(F.col("on_time_pct").asc())
    out = labelled.withColumns(
        {
            "rolling_7d_on_time_pct": r(F.avg("on_time_pct").over(w7), 2),
            "rolling_7d_avg_delay": r(F.avg("avg_delay_min").over(w7), 2),
            "daily_reliability_rank": F.rank().over(by_day),
        }
    )
    return out.orderBy("route", "date") if sort else out


def route_hourly(delays: DataFrame, sort: bool = True, selection: bool = False) -> DataFrame:
    """One row per (route, hour, time_period, is_rush_hour)."""
    keys = ["route", "hour", "time_period", "is_rush_hour"]
    rows = reduced(as_cells(delays), keys, _sums(["precip_mm"], ["is_precipitation"]))
    out = summarise(rows, keys, {
        "total_incidents": F.sum("n"),
        "avg_delay_min": r(ratio("delay"), 2),
        "median_delay_min": Quantile(0.5, 2),
        "on_time_pct": r(_share("is_on_time"), 2),
        "significant_delay_pct": r(_share("is_significant"), 2),
        "total_delay_hrs": r(F.sum("delay") / F.lit(60.0), 2),
        "avg_precip_mm": r(ratio("precip_mm"), 2),
        "avg_delay_wet": r(_cond_avg("is_precipitation", 1), 2),
        "avg_delay_dry": r(_cond_avg("is_precipitation", 0), 2),
    }, selection)
    return out.orderBy("route", "hour") if sort else out


def weather_impact(delays: DataFrame, sort: bool = True, selection: bool = False) -> DataFrame:
    """Delay statistics by (weather_condition, severity_bucket), matched weather only."""
    base = as_cells(delays).filter(
        F.col("weather_condition").isNotNull() & (F.col("weather_condition") != F.lit("Unknown"))
    ).withColumn("severity_bucket", severity_bucket())
    keys = ["weather_condition", "severity_bucket"]
    rows = reduced(base, keys, _sums(["temp_c", "precip_mm", "snow_cm"]))
    out = summarise(rows, keys, {
        "total_incidents": F.sum("n"),
        "avg_delay_min": r(ratio("delay"), 2),
        "median_delay_min": Quantile(0.5, 2),
        "p95_delay_min": Quantile(0.95, 1),
        "on_time_pct": r(_share("is_on_time"), 2),
        "significant_delay_pct": r(_share("is_significant"), 2),
        "severe_delay_pct": r(_share("is_severe"), 2),
        "avg_temp_c": r(ratio("temp_c"), 1),
        "avg_precip_mm": r(ratio("precip_mm"), 2),
        "avg_snow_cm": r(ratio("snow_cm"), 2),
    }, selection)
    return out.orderBy(F.col("avg_delay_min").desc()) if sort else out


def network_summary(delays: DataFrame, sort: bool = True) -> DataFrame:
    """Daily network KPIs with 30-row rolling means.

    The rolling window has no partition key: it runs on the one-row-per-day
    table (bounded by the calendar: 366 rows a year), never on incidents.
    """
    d = as_cells(delays).withColumn("delay", delay_sum())
    base = d.groupBy(F.col("date").cast("date").alias("date")).agg(
        F.max("is_weekend").alias("is_weekend"),
        F.sum("n").alias("total_incidents"),
        F.countDistinct("route").alias("routes_affected"),
        r(ratio("delay"), 2).alias("avg_delay_min"),
        r(_share("is_on_time"), 2).alias("network_on_time_pct"),
        r(_share("is_significant"), 2).alias("network_significant_pct"),
        r(F.sum("delay") / F.lit(60.0), 1).alias("total_delay_hrs"),
        r(ratio("temp_c"), 1).alias("avg_temp_c"),
        r(F.sum("precip_mm"), 1).alias("total_precip_mm"),
        F.max("weather_severity").alias("max_weather_severity"),
        F.max("is_snow").alias("had_snow"),
        F.max("is_extreme_cold").alias("had_extreme_cold"),
    )
    labelled = base.withColumns({"year_month": cal.year_month("date"), "day_name": cal.day_name("date")})
    w30 = Window.orderBy("date").rowsBetween(-29, Window.currentRow)
    out = labelled.withColumns(
        {
            "rolling_30d_on_time_pct": r(F.avg("network_on_time_pct").over(w30), 2),
            "rolling_30d_avg_delay": r(F.avg("avg_delay_min").over(w30), 2),
        }
    )
    return out.orderBy("date") if sort else out


def _sensitivity(flag: str) -> Column:
    return r(_cond_avg(flag, 1) - _cond_avg(flag, 0), 2)


def route_stats(delays: DataFrame, min_incidents: int = MIN_ROUTE_INCIDENTS, selection: bool = False) -> DataFrame:
    """Per-route statistics and sensitivities for routes with at least ``min_incidents`` rows."""
    rows = reduced(as_cells(delays), ["route"], _sums(split=["is_precipitation", "is_snow", "is_rush_hour"]))
    stats = summarise(rows, ["route"], {
        "total_incidents": F.sum("n"),
        "mean_delay_min": r(ratio("delay"), 2),
        "median_delay_min": Quantile(0.5, 2),
        "p95_delay_min": Quantile(0.95, 1),
        "on_time_pct": r(_share("is_on_time"), 2),
        "significant_delay_pct": r(_share("is_significant"), 2),
        "severe_delay_pct": r(_share("is_severe"), 2),
        "total_delay_hrs": r(F.sum("delay") / F.lit(60.0), 1),
        "weather_sensitivity_precip": _sensitivity("is_precipitation"),
        "weather_sensitivity_snow": _sensitivity("is_snow"),
        "rush_hour_sensitivity": _sensitivity("is_rush_hour"),
    }, selection)
    return stats.filter(F.col("total_incidents") >= F.lit(min_incidents))


def route_sensitivity(delays: DataFrame, min_incidents: int = MIN_ROUTE_INCIDENTS) -> DataFrame:
    """The three sensitivities per route (differences of conditional means, missing side -> 0)."""
    s = route_stats(delays, min_incidents)
    return s.select(
        "route",
        "total_incidents",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in
          ("weather_sensitivity_precip", "weather_sensitivity_snow", "rush_hour_sensitivity")],
    )


def min_max_norm(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """(x - min) / (max - min) over the whole table, null when the range is 0.

    min and max come from one scalar subquery (a single-row aggregate), so the
    table itself is never moved into one partition.  The subquery reads ``df``
    again: pass a stored table, not a lazy aggregate over the fact table.
    """
    bounds = df.select(
        F.struct(
            *[F.min(src).alias(f"mn_{src}") for src in cols.values()],
            *[F.max(src).alias(f"mx_{src}") for src in cols.values()],
        ).alias("b")
    ).scalar()
    df = df.withColumn("_bounds", bounds)  # the subquery appears once in the plan
    exprs = {}
    for out, src in cols.items():
        mn, mx = F.col(f"_bounds.mn_{src}"), F.col(f"_bounds.mx_{src}")
        exprs[out] = (F.col(src) - mn) / F.nullif(mx - mn, F.lit(0))
    return df.withColumns(exprs).drop("_bounds")


def risk_expression(prefix_cols=RISK_WEIGHTS) -> Column:
    total = None
    for name, weight in prefix_cols:
        term = F.lit(weight) * F.coalesce(F.col(name), F.lit(0.0))
        total = term if total is None else total + term
    return total


def route_risk_scores(delays: DataFrame, min_incidents: int = MIN_ROUTE_INCIDENTS, sort: bool = True) -> DataFrame:
    """Composite risk score, tier and rank per route.

    Tier and rank use the unrounded score; the published score has 4 decimals.
    The rank window has no partition key: it runs on the per-route table
    (one row per route), never on incidents.
    """
    return route_risk_from_stats(route_stats(delays, min_incidents), sort)


def route_risk_from_stats(stats: DataFrame, sort: bool = True) -> DataFrame:
    """Risk scores from :func:`route_stats` output.  The min/max bounds read
    ``stats`` a second time, so pass a stored table (the pipeline does)."""
    normed = min_max_norm(
        stats,
        {
            "sig_norm": "significant_delay_pct",
            "mean_norm": "mean_delay_min",
            "p95_norm": "p95_delay_min",
            "vol_norm": "total_incidents",
        },
    )
    scored = normed.withColumn("_risk", risk_expression())
    out = scored.select(
        "route",
        "total_incidents",
        "mean_delay_min",
        "median_delay_min",
        "p95_delay_min",
        "on_time_pct",
        "significant_delay_pct",
        "severe_delay_pct",
        "total_delay_hrs",
        F.coalesce("weather_sensitivity_precip", F.lit(0.0)).alias("weather_sensitivity_precip"),
        F.coalesce("weather_sensitivity_snow", F.lit(0.0)).alias("weather_sensitivity_snow"),
        F.coalesce("rush_hour_sensitivity", F.lit(0.0)).alias("rush_hour_sensitivity"),
        r(F.col("_risk"), 4).alias("risk_score"),
        risk_tier(F.col("_risk")).alias("risk_tier"),
        F.rank().over(Window.orderBy(F.col("_risk").desc())).alias("risk_rank"),
    )
    return out.orderBy(F.col("risk_score").desc()) if sort else out
