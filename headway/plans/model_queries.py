"""Model-backed query keys.

Tree ensembles are not bit-comparable across libraries, so each key of model outputs has a
companion (``..._rows``, ``..._facts``) with what SQL can decide about them: the row set, labels
and folds, the columns that are not the model's, and identities that its outputs obey.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.forecast import forecast_summary, score_alerts
from headway.plans.model import KEY, LABEL, assemble, feature_importance, worst_case_scores
from headway.plans.stages import model_stages, stages


def q_gbt_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = model_stages(spark, sf_dir)
    return ms.raw_trees.predict(ms.train, "gbt_prob").select(*KEY, LABEL, "gbt_prob")


def q_gbt_calibrated(spark, sf_dir):
    ms = model_stages(spark, sf_dir)
    return ms.calibrated.predict(ms.train, "gbt_prob").select(*KEY, LABEL, "gbt_prob")


def q_lr_calibrated(spark, sf_dir):
    ms = model_stages(spark, sf_dir)
    return ms.linear.predict(ms.train, "lr_prob").select(*KEY, LABEL, "lr_prob")


def q_oof_scores(spark, sf_dir):
    return model_stages(spark, sf_dir).oof


def q_feature_importance(spark, sf_dir):
    return feature_importance(spark, model_stages(spark, sf_dir).raw_trees)


def q_worst_case_risk(spark, sf_dir):
    st = stages(spark, sf_dir)
    return worst_case_scores(st.route_risk, st.route_encoder, st.period_encoder, model_stages(spark, sf_dir).calibrated)


def scored_alerts(spark, sf_dir, sort: bool = True) -> DataFrame:
    st = stages(spark, sf_dir)
    g = model_stages(spark, sf_dir).calibrated.predict(assemble(st.grid), "degradation_prob").drop("features")
    return score_alerts(g, sort=sort)


def q_forecast_scored(spark, sf_dir):
    return scored_alerts(spark, sf_dir).select(
        "route", "datetime", "date", "hour", "degradation_prob", "risk_score", "alert_score", "alert_level"
    )


def q_forecast_summary_model(spark, sf_dir):
    return forecast_summary(scored_alerts(spark, sf_dir, sort=False))


def q_model_metrics(spark, sf_dir):
    """(metric, value): in-sample calibrated AUC, out-of-fold AUC, average precision,
    Brier score, calibrated linear AUC, base rate, window count."""
    from headway.plans.full_run import model_metrics

    ms = model_stages(spark, sf_dir)
    return model_metrics(ms.calibrated, ms.linear, ms.oof, ms.train)


def _in_unit(p) -> "F.Column":
    return (p >= 0) & (p <= 1)


def _train_rows(scored: DataFrame, prob: str) -> DataFrame:
    return scored.select(*KEY, LABEL, _in_unit(F.col(prob)).alias("in_unit"))


def q_gbt_train_rows(spark, sf_dir):
    return _train_rows(q_gbt_train_score(spark, sf_dir), "gbt_prob")


def q_gbt_calibrated_rows(spark, sf_dir):
    return _train_rows(q_gbt_calibrated(spark, sf_dir), "gbt_prob")


def q_lr_calibrated_rows(spark, sf_dir):
    return _train_rows(q_lr_calibrated(spark, sf_dir), "lr_prob")


def q_oof_rows(spark, sf_dir):
    o = q_oof_scores(spark, sf_dir)
    return o.select(*KEY, F.col("label").cast("int").alias("label"), "oof_fold", _in_unit(F.col("oof_prob")).alias("in_unit"))


def q_importance_facts(spark, sf_dir):
    imp = q_feature_importance(spark, sf_dir)
    total = imp.select(F.round(F.sum("importance"), 6).alias("t")).scalar()
    return imp.select("feature", (F.col("importance") >= 0).alias("not_negative"), (total == 1).alias("sum_is_one"))


def q_worst_case_rows(spark, sf_dir):
    w = q_worst_case_risk(spark, sf_dir)
    return w.withColumn("in_unit", _in_unit(F.col("ml_degradation_prob_worst_case"))).drop("ml_degradation_prob_worst_case")


def q_forecast_scored_rows(spark, sf_dir):
    """The grid's rows; whether score and level follow from the probability."""
    f = q_forecast_scored(spark, sf_dir)
    score = 0.6 * F.col("degradation_prob") + 0.4 * F.col("risk_score")
    level = F.ceil((F.col("alert_score") - 0.05) * 5)  # bins of 0.2 that begin at 0.25
    names = F.array(*[F.lit(x) for x in ("Normal", "Watch", "Warning", "Alert")])
    want = F.element_at(names, F.least(F.greatest(level, F.lit(1)), F.lit(4)).cast("int"))
    return f.select(
        "route", "datetime", "date", F.col("hour").cast("int").alias("hour"), "risk_score", _in_unit(F.col("degradation_prob")).alias("in_unit"),
        (F.abs(F.col("alert_score") - score) < 0.000051).alias("score_follows"),
        ((F.col("alert_level") == want) | (F.abs((F.col("alert_score") - 0.05) * 5 - F.round((F.col("alert_score") - 0.05) * 5)) < 1e-6)).alias("level_follows"),
    )


def q_forecast_summary_model_rows(spark, sf_dir):
    s = q_forecast_summary_model(spark, sf_dir)
    return s.select("date", "day_name", "route", "risk_tier", _in_unit(F.col("max_degradation_prob")).alias("in_unit"))


def q_model_metric_facts(spark, sf_dir):
    """Window count and base rate; that the ranking metrics lie in [0, 1], the calibrated trees rank
    better than chance and their Brier score is below that of the base rate."""
    m = q_model_metrics(spark, sf_dir).groupBy().pivot("metric", ["n_windows", "base_rate", "gbt_auc", "gbt_oof_auc", "gbt_pr_auc", "gbt_brier", "lr_auc"]).agg(F.first("value"))
    unit = _in_unit(F.col("gbt_oof_auc")) & _in_unit(F.col("gbt_pr_auc")) & _in_unit(F.col("lr_auc"))
    b = F.col("base_rate")
    return m.select(
        F.col("n_windows").cast("long").alias("n_windows"), F.round("base_rate", 10).alias("base_rate"), unit.alias("in_unit"),
        (F.col("gbt_auc") > 0.5).alias("better_than_chance"), (F.col("gbt_brier") < b * (1 - b)).alias("brier_below_base"),
    )


MODEL_QUERIES = {
    "gbt_train_score": q_gbt_train_score,
    "gbt_calibrated": q_gbt_calibrated,
    "lr_calibrated": q_lr_calibrated,
    "oof_scores": q_oof_scores,
    "feature_importance": q_feature_importance,
    "worst_case_risk": q_worst_case_risk,
    "forecast_scored": q_forecast_scored,
    "forecast_summary_model": q_forecast_summary_model,
    "model_metrics": q_model_metrics,
}

COMPANIONS = {
    "gbt_train_rows": q_gbt_train_rows,
    "gbt_calibrated_rows": q_gbt_calibrated_rows,
    "lr_calibrated_rows": q_lr_calibrated_rows,
    "oof_rows": q_oof_rows,
    "importance_facts": q_importance_facts,
    "worst_case_rows": q_worst_case_rows,
    "forecast_scored_rows": q_forecast_scored_rows,
    "forecast_summary_model_rows": q_forecast_summary_model_rows,
    "model_metric_facts": q_model_metric_facts,
}
