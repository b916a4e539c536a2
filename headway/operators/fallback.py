"""Fallback route risk, used when the SQL risk table comes out empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.numeric import r
from headway.operators.cells import as_cells, delay_sum
from headway.operators.quantiles import Quantile, ratio, reduced, summarise
from headway.operators.tables import min_max_norm

# Right-closed tier bins on the rounded score:
# (-0.001, 0.35] Low, (0.35, 0.55] Medium, (0.55, 0.75] High, (0.75, 1.0] Critical.
FALLBACK_TIERS = [("Low", -0.001, 0.35), ("Medium", 0.35, 0.55), ("High", 0.55, 0.75), ("Critical", 0.75, 1.0)]

NORMED = ["significant_delay_pct", "mean_delay_min", "p95_delay_min", "total_incidents"]
WEIGHTS = [0.35, 0.30, 0.20, 0.15]


def fallback_tier(score: Column) -> Column:
    expr = None
    for label, lo, hi in FALLBACK_TIERS:
        cond = (score > F.lit(lo)) & (score <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def route_risk_fallback(delays: DataFrame, sort: bool = True) -> DataFrame:
    """Unrounded per-route statistics for every route, sensitivities 0, a rounded
    score, tiers on the rounded score and the average rank truncated to an integer.

    The rank windows run on the per-route table, never on incidents.
    """
    return fallback_from_stats(fallback_stats(delays), sort)


def fallback_stats(delays: DataFrame, selection: bool = False) -> DataFrame:
    flags = {"is_on_time": "on_time_pct", "is_significant": "significant_delay_pct", "is_severe": "severe_delay_pct"}
    rows = reduced(as_cells(delays), ["route"], {"delay": delay_sum(), **{f: F.col(f) for f in flags}})
    g = summarise(rows, ["route"], {
        "total_incidents": F.sum("n"),
        "mean_delay_min": ratio("delay"),
        **{c: ratio(f) * F.lit(100.0) for f, c in flags.items()},
        "total_delay_hrs": F.sum("delay") / F.lit(60.0),
        "median_delay_min": Quantile(0.5),
        "p95_delay_min": Quantile(0.95),
    }, selection)
    return g.withColumns({"weather_sensitivity_precip": F.lit(0.0), "rush_hour_sensitivity": F.lit(0.0)})


def fallback_from_stats(g: DataFrame, sort: bool = True) -> DataFrame:
    """Scores, tiers and ranks from :func:`fallback_stats` (pass a stored table:
    the normalisation bounds read it twice)."""
    g = g.withColumns({"weather_sensitivity_precip": F.lit(0.0), "rush_hour_sensitivity": F.lit(0.0)})
    g = min_max_norm(g, {f"{c}_norm": c for c in NORMED})
    g = g.withColumns({f"{c}_norm": F.coalesce(F.col(f"{c}_norm"), F.lit(0.0)) for c in NORMED})
    score = None
    for c, w in zip(NORMED, WEIGHTS):
        term = F.lit(w) * F.col(f"{c}_norm")
        score = term if score is None else score + term
    g = g.withColumn("risk_score", r(score, 4)).withColumn("risk_tier", fallback_tier(F.col("risk_score")))
    first = F.rank().over(Window.orderBy(F.col("risk_score").desc()))
    ties = F.count(F.lit(1)).over(Window.partitionBy("risk_score"))
    g = g.withColumn("risk_rank", F.floor((first * 2 + ties - 1) / 2).cast("int"))
    return g.orderBy(F.col("risk_score").desc()) if sort else g
