"""Materialised pipeline stages over one input folder.

The fact table and the small tables that many jobs reuse (route risk,
training windows and features, encoders, the forecast grid) are each written
once as Parquet under the session's shared checkpoint folder and read back.
That is what the pipeline does anyway (compute ``delays`` once, reuse it for
every table), it keeps every downstream plan small, and it cuts lineage so a
lost executor never forces a recompute from the raw scan.
"""

from __future__ import annotations

import logging
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.operators import tables
from headway.operators.cells import build_cells
from headway.operators.delays import build_delays
from headway.operators.enrich import enrich_weather
from headway.operators.fallback import fallback_from_stats, fallback_stats
from headway.operators.joins import match_counts
from headway.operators.forecast import forecast_grid, forecast_summary, score_alerts
from headway.operators.quantiles import many_values
from headway.operators.windows import label_windows, route_p60, training_features, window_aggregates
from headway.plans.model import FittedTrees, LinearParams, TreeParams, fit_all_trees, fit_calibrated_linear, training_frame
from headway.session import materialize, remove_path, run_folder
from headway.sources.inputs import FixtureInputs

log = logging.getLogger(__name__)


class Stages:
    """Stored stages of one run.  ``inputs`` defaults to the fixture tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, inputs=None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.inputs = inputs or FixtureInputs(spark, sf_dir)
        self.run_id = uuid.uuid4().hex

    def _m(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, self.spark, folder=f"headway/{self.run_id}")

    def release(self) -> None:
        """Delete every table this run stored under the checkpoint folder."""
        folder = run_folder(self.spark, self.run_id)
        if folder:
            remove_path(self.spark, folder)

    @cached_property
    def raw_weather(self) -> DataFrame:
        """Hourly weather as read, stored: its size is checked before the join that reads it again."""
        return self._m(self.inputs.weather(), "raw_weather")

    @cached_property
    def delays(self) -> DataFrame:
        built = build_delays(self.inputs.incidents(), self.raw_weather, self.inputs.weather_keys)
        seen = Observation(f"delays-{self.run_id}")
        stored = self._m(built.observe(seen, *match_counts()), "delays")
        self.observed = seen.get  # rows and matches, counted while the table was written
        return stored

    @property
    def match_rate(self) -> DataFrame:
        """What :func:`weather_match_rate` gives, from the counts taken while the fact table was written."""
        _ = self.delays
        seen = self.observed
        n = seen["rows"]
        rates = [seen[c] / n if n else None for c in ("not_ten", "not_unknown")]
        return self.spark.createDataFrame([(n, *rates)], "rows long, weather_match_rate double, matched_rate double")

    @cached_property
    def cells(self) -> DataFrame:
        """The roll-up that every table reads: one scan of the fact table."""
        return self._m(build_cells(self.delays, self.inputs.ordinal), "cells")

    @cached_property
    def selection(self) -> bool:
        """Whether quantiles are searched for by rank: some group may have too many values to gather."""
        return many_values(self.cells)

    @cached_property
    def weather(self) -> DataFrame:
        return self._m(enrich_weather(self.raw_weather), "weather")

    @cached_property
    def route_daily(self) -> DataFrame:
        return self._m(tables.route_daily(self.cells, sort=False, selection=self.selection), "route_daily")

    @cached_property
    def route_hourly(self) -> DataFrame:
        return self._m(tables.route_hourly(self.cells, sort=False, selection=self.selection), "route_hourly")

    @cached_property
    def weather_impact(self) -> DataFrame:
        return self._m(tables.weather_impact(self.cells, sort=False, selection=self.selection), "weather_impact")

    @cached_property
    def network_summary(self) -> DataFrame:
        return self._m(tables.network_summary(self.cells, sort=False), "network_summary")

    @cached_property
    def route_stats(self) -> DataFrame:
        return self._m(tables.route_stats(self.cells, selection=self.selection), "route_stats")

    @cached_property
    def route_risk(self) -> DataFrame:
        """The risk table, or the fallback over all routes where no route has enough incidents."""
        risk = self._m(tables.route_risk_from_stats(self.route_stats, sort=False), "route_risk")
        if not risk.isEmpty():
            return risk
        log.warning("no route has enough incidents for the risk table: the fallback scores all routes")
        every = fallback_from_stats(self.fallback_stats, sort=False)
        more = [F.lit(0.0).alias(c) for c in risk.columns if c not in every.columns]
        return self._m(every.select("*", *more).select(*risk.columns), "route_risk_fallback")

    @cached_property
    def fallback_stats(self) -> DataFrame:
        return self._m(fallback_stats(self.cells, selection=self.selection), "fallback_stats")

    @cached_property
    def window_aggregates(self) -> DataFrame:
        return self._m(window_aggregates(self.cells), "window_aggregates")

    @cached_property
    def route_p60(self) -> DataFrame:
        """One row per route, stored: the window join then broadcasts it statically
        instead of shuffling the windows by route (a hot route would be one task)."""
        return self._m(route_p60(self.cells, selection=self.selection), "route_p60")

    @cached_property
    def windows(self) -> DataFrame:
        return self._m(label_windows(self.window_aggregates, self.route_p60, fill="auto"), "windows")

    @cached_property
    def _features(self):
        f, _, _ = training_features(self.windows, self.route_risk)
        f = self._m(f, "features")
        # encoders re-derived from the stored features (same sorted labels and codes)
        renc = f.select(F.col("route").alias("label"), F.col("route_enc").alias("code")).distinct()
        penc = f.select(
            F.coalesce(F.col("time_period"), F.lit("Unknown")).alias("label"), F.col("time_period_enc").alias("code")
        ).distinct()
        return f, renc, penc

    @property
    def features(self) -> DataFrame:
        return self._features[0]

    @property
    def route_encoder(self) -> DataFrame:
        return self._features[1]

    @property
    def period_encoder(self) -> DataFrame:
        return self._features[2]

    @cached_property
    def forecast_weather(self) -> DataFrame:
        return self._m(enrich_weather(self.inputs.forecast_weather()), "forecast_weather")

    @cached_property
    def grid(self) -> DataFrame:
        g = forecast_grid(self.route_risk, self.forecast_weather, self.route_encoder, self.period_encoder)
        return self._m(g, "grid")

    @cached_property
    def models(self) -> "ModelStages":
        return ModelStages(self)

    @cached_property
    def standin_alerts(self) -> DataFrame:
        """Alerts with the deterministic stand-in probability (bucket hour / 24)."""
        g = self.grid.withColumn("degradation_prob", F.col("hour") / F.lit(24.0))
        return score_alerts(g, sort=False)

    @cached_property
    def standin_summary(self) -> DataFrame:
        return self._m(forecast_summary(self.standin_alerts, sort=False), "summary")


_REGISTRY: dict[tuple[str, str], tuple[str, Stages]] = {}


def _state(spark: SparkSession, sf_dir: str) -> str:
    """What tells whether the input files are still the same: names, sizes and times."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return repr(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    """One set of stored stages per (application, input folder); made anew, and the old one
    released, when the folder's files have changed."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    state = _state(spark, sf_dir)
    had = _REGISTRY.get(key)
    if had is None or had[0] != state:
        if had is not None:
            had[1].release()
        _REGISTRY[key] = (state, Stages(spark, sf_dir))
    return _REGISTRY[key][1]


def release_all() -> None:
    """Delete what the registered queries have stored."""
    for _, st in _REGISTRY.values():
        st.release()
    _REGISTRY.clear()


# ---------------------------------------------------------------- models
class ModelStages:
    """The fits of the registered queries, each made when a query first needs it: the nine tree
    fits (200 trees each, as published) in one pass, the linear ones in another."""

    def __init__(self, st: Stages, n_trees: int = 200):
        self.st = st
        self.params = TreeParams(n_trees=n_trees)

    @cached_property
    def train(self) -> DataFrame:
        return self.st._m(training_frame(self.st.features), "train")

    @cached_property
    def trees(self) -> FittedTrees:
        return fit_all_trees(self.train, self.params)

    @property
    def calibrated(self):
        return self.trees.calibrated

    @property
    def raw_trees(self):
        return self.trees.raw

    @property
    def oof(self) -> DataFrame:
        return self.trees.oof

    @cached_property
    def linear(self):
        return fit_calibrated_linear(self.train, LinearParams())


def model_stages(spark: SparkSession, sf_dir: str) -> ModelStages:
    return stages(spark, sf_dir).models
