"""The full run: fact table -> five tables -> training data -> models -> forecast -> sinks.

Each step is a Spark job over the previous step's materialised output; the
fact table is written once under the shared checkpoint folder and every table
reads it.  ``run`` returns the produced DataFrames and per-step seconds.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.operators import dashboard as db
from headway.operators.forecast import forecast_summary, score_alerts
from headway.operators.metrics import brier, ranking_metrics
from headway.plans.model import (
    LinearParams,
    TreeParams,
    assemble,
    feature_importance,
    fit_all,
    fit_calibrated_trees,
    load_models,
    prepared,
    save_models,
    worst_case_scores,
)
from headway.plans.stages import Stages
from headway.session import apply_conf, cluster_conf, input_bytes, materialize
from headway.sources.publish import new_version, publish
from headway.sources.sinks import metrics_long, write_table


def _force(df: DataFrame) -> None:
    """Run a DataFrame to completion without collecting it."""
    df.write.format("noop").mode("overwrite").save()


class Timer:
    def __init__(self):
        self.seconds: dict[str, float] = {}

    @contextmanager
    def __call__(self, name: str):
        t0 = time.perf_counter()
        yield
        self.seconds[name] = round(time.perf_counter() - t0, 3)


def read_written(spark: SparkSession, out_dir: str, name: str, fmt: str) -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(f"{out_dir}/{name}")


def table_report(spark: SparkSession, out_dir: str, rows: dict[str, int]) -> DataFrame:
    """(table, rows, bytes) of the written tables: rows as observed while they were written, bytes from the
    file system; nothing is read back."""
    found = [(name, n, input_bytes(spark, f"{out_dir}/{name}")) for name, n in rows.items()]
    return spark.createDataFrame(found, "table string, rows long, bytes long")


def run_jobs(jobs: dict[str, "callable"], parallelism: int) -> dict:
    """Submit independent jobs side by side (each is its own chain of Spark jobs)."""
    if parallelism <= 1:
        return {k: f() for k, f in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(parallelism, len(jobs))) as ex:
        futures = {k: ex.submit(f) for k, f in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


def model_metrics(model, linear, oof: DataFrame, train: DataFrame) -> DataFrame:
    """(metric, value) rows: AUCs of the three score sets in one grouped ranking pass,
    average precision and Brier score of the calibrated trees, base rate, window count."""
    g = model.predict(train, "score").select(F.lit("gbt").alias("model"), "score", "label")
    lr = linear.predict(train, "score").select(F.lit("lr").alias("model"), "score", "label")
    o = oof.select(F.lit("oof").alias("model"), F.col("oof_prob").alias("score"), "label")
    scores = materialize(g.unionByName(lr).unionByName(o), "model-scores")
    rk = ranking_metrics(scores, by=["model"])
    wide = rk.groupBy().pivot("model", ["gbt", "oof", "lr"]).agg(
        F.first("auc").alias("auc"), F.first("average_precision").alias("ap"), F.first("n").alias("n")
    )
    br = brier(scores.filter(F.col("model") == "gbt")).select(F.struct("brier", "base_rate")).scalar()
    one = wide.withColumn("_b", br).select(
        F.col("gbt_auc"),
        F.col("oof_auc").alias("gbt_oof_auc"),
        F.col("gbt_ap").alias("gbt_pr_auc"),
        F.col("_b.brier").alias("gbt_brier"),
        F.col("lr_auc"),
        F.col("_b.base_rate").alias("base_rate"),
        F.col("gbt_n").alias("n_windows"),
    )
    return metrics_long(one)


def run(
    spark: SparkSession,
    sf_dir: str | None = None,
    out_dir: str | None = None,
    n_trees: int = 200,
    with_cv_metrics: bool = True,
    fmt: str = "parquet",
    parallelism: int = 8,
    inputs=None,
    release: bool | None = None,
    fit_partitions: int | None = None,
    size_conf: bool = True,
) -> tuple[dict[str, DataFrame], dict[str, float]]:
    """The full run over the fixture tables in ``sf_dir``, or over ``inputs``
    (e.g. :class:`headway.sources.inputs.FileInputs`).

    ``release`` deletes the stored intermediate stages at the end (default: only
    when ``out_dir`` is given).  Returned DataFrames that read those stages must
    be used before they are released; the written tables stay.

    With ``out_dir`` the models, the standardiser and the encoders are saved under
    ``out_dir/models`` and everything is scored with what is read back from there.
    ``size_conf`` sets the session's shuffle partitions and split sizes from the input's
    bytes.  The fact table is the temp view ``delays`` until the stages are released."""
    st = Stages(spark, sf_dir, inputs)
    t = Timer()
    out: dict[str, DataFrame] = {}

    written: dict[str, int] = {}

    def emit(name: str, df: DataFrame):
        out[name] = df
        if out_dir:
            seen = Observation(f"{name}-{st.run_id}")
            write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), out_dir, name, fmt)
            written[name] = seen.get["rows"]
        else:
            _force(df)

    if size_conf:
        apply_conf(spark, cluster_conf(st.inputs.fact_bytes(), spark.sparkContext.defaultParallelism))
    with t("delays"):
        d = st.delays
        d.createOrReplaceTempView("delays")
    with t("tables_and_training_data"):
        # wave 1: the four tables and the independent stored stages, side by side
        # (each job touches its own stage, so none is computed twice)
        jobs = {
            name: (lambda name=name: emit(name, getattr(st, name)))
            for name in ("route_daily", "route_hourly", "weather_impact", "network_summary")
        }
        jobs["route_risk"] = lambda: st.route_risk
        jobs["window_aggregates"] = lambda: st.window_aggregates
        jobs["route_p60"] = lambda: st.route_p60
        run_jobs(jobs, parallelism)
        rr = st.route_risk
        # wave 2: the training-data chain (windows -> features -> training frame), then the grid
        rows, scaler = prepared(st.features)
        train = st._m(rows, "train")
        emit("route_risk_scores_base", rr)
        grid = st.grid
    params = TreeParams(n_trees=n_trees)
    with t("model_fit"):
        if with_cv_metrics:
            fitted = fit_all(train, params, LinearParams(), partitions=fit_partitions)
            model = fitted.calibrated
        else:
            model = fit_calibrated_trees(train, params, partitions=fit_partitions)
    if with_cv_metrics and out_dir:
        with t("save_and_load_models"):
            fitted.oof = st._m(fitted.oof, "oof")
            save_models(fitted, f"{out_dir}/models", {"route": st.route_encoder, "time_period": st.period_encoder}, scaler)
            saved = load_models(spark, f"{out_dir}/models")
            model, fitted.linear, fitted.raw = saved.calibrated, saved.linear, saved.raw

    def forecast():
        scored = model.predict(assemble(grid), "degradation_prob").drop("features")
        alerts = st._m(score_alerts(scored, sort=False), "alerts")
        summary = st._m(forecast_summary(alerts, sort=False), "forecast_summary")
        emit("tomorrow_forecast", summary)
        return summary

    with t("scoring_metrics_forecast"):
        jobs = {
            "route_risk_scores": lambda: emit(
                "route_risk_scores", worst_case_scores(rr, st.route_encoder, st.period_encoder, model)),
            "forecast": forecast,
        }
        if with_cv_metrics:
            jobs["model_metrics"] = lambda: emit("model_metrics", model_metrics(model, fitted.linear, fitted.oof, train))
            jobs["feature_importance"] = lambda: emit("feature_importance", feature_importance(spark, fitted.raw))
        summary = run_jobs(jobs, parallelism)["forecast"]
    with t("dashboard"):
        # the written table when it is typed Parquet, else recomputed from the stored fact table
        typed = out_dir and fmt == "parquet"
        rd = read_written(spark, out_dir, "route_daily", fmt) if typed else st.route_daily
        run_jobs(
            {
                "kpi_summary": lambda: emit("kpi_summary", db.kpi_summary(rd)),
                "delay_uplift": lambda: emit("delay_uplift", db.delay_uplift(rd)),
                "alert_matrix": lambda: emit("alert_matrix", db.alert_matrix(summary, rr)),
                "risk_by_day": lambda: emit("risk_by_day", db.risk_by_day(summary)),
            },
            parallelism,
        )
    if out_dir:
        with t("table_report"):
            emit("table_report", table_report(spark, out_dir, written))
    if release is None:
        release = bool(out_dir)
    if release:
        spark.catalog.dropTempView("delays")
        st.release()  # drop the intermediate copies under the checkpoint folder
    return out, t.seconds


def run_published(spark: SparkSession, base: str, runner=run, **kw) -> tuple[dict[str, DataFrame], dict[str, float]]:
    """A run (``run`` or ``run_files``, whose other arguments ``kw`` gives) published under ``base`` at once.

    Everything is written to a version folder; the manifest is swapped when all of it is there.  A run that fails
    leaves the published version as it was, and its own folder to the next one's clean-up.
    """
    folder = new_version(base)
    out, seconds = runner(spark, out_dir=folder, **kw)
    rows = {r.table: r.rows for r in read_written(spark, folder, "table_report", kw.get("fmt", "parquet")).collect()}  # one row a table
    publish(spark, base, folder, {k: int(v) for k, v in rows.items()}, kw.get("fmt", "parquet"))
    return out, seconds


def run_files(
    spark: SparkSession,
    incidents_dir: str,
    weather_path: str,
    forecast_path: str,
    out_dir: str,
    years: tuple[int, ...] = (2024,),
    cache_dir: str | None = None,
    skip_unreadable: bool = False,
    **kw,
) -> tuple[dict[str, DataFrame], dict[str, float]]:
    """The published run from its own inputs: yearly incident CSV files, hourly
    weather documents for the year and a 7-day forecast document.

    With ``cache_dir`` raw rows are served from a Parquet cache there, and only files that are new or have
    changed since the last run are read."""
    from headway.sources.inputs import FileInputs

    inputs = FileInputs(spark, incidents_dir, weather_path, forecast_path, tuple(years), cache_dir, skip_unreadable)
    return run(spark, None, out_dir=out_dir, inputs=inputs, **kw)
