"""Degradation classifiers.

* boosted trees (200 trees, step 0.06, depth 4, subsample 0.8, min leaf 20, seed 42), all nine fits grown
  together (:mod:`headway.plans.boosting`);
* isotonic calibration, 3 folds: each fold's trees are fitted on the other two
  folds and an isotonic map (tree margin -> probability) on the held-out fold
  (:mod:`headway.plans.isotonic`); the calibrated probability is the mean over the three;
* logistic regression on population-standardised features with L2 strength
  C = 0.5 (``regParam = 1 / (C * n)``), Platt-calibrated the same 3-fold way (Spark ML);
* 5-fold stratified out-of-fold tree probabilities;
* feature importances of one tree model fitted on everything.

Training rows are the two-hour windows (one row per route x day x bucket).  Trees and calibration do not depend
on how the rows are partitioned; scoring is one Arrow-batched pass for all models of a step.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.metrics import stratified_fold_columns
from headway.operators.windows import FEATURES
from headway.plans import boosting
from headway.plans.boosting import Fit, TreeTable
from headway.plans.isotonic import Steps, fit_isotonic, steps_of, steps_rows
from headway.session import materialize

KEY = ["route", "date", "hour_bucket"]
LABEL = "degraded"

@dataclass
class TreeParams:
    n_trees: int = 200
    step: float = 0.06
    depth: int = 4
    subsample: float = 0.8
    min_leaf: int = 20
    seed: int = 42
    max_bins: int = 32

    def fit(self, train: DataFrame, fits: list[Fit], partitions: int | None = None) -> list[TreeTable]:
        return boosting.fit_trees(
            train, KEY, fits, self.n_trees, self.step, self.depth, self.subsample, self.min_leaf, self.seed, self.max_bins, partitions=partitions
        )


@dataclass
class LinearParams:
    C: float = 0.5
    max_iter: int = 1000


def assemble(df: DataFrame, cols: list[str] = FEATURES, out: str = "features") -> DataFrame:
    """Feature vector in the fixed order; a missing feature value is 0 (training and scoring alike)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(
        df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})
    )


def training_frame(features: DataFrame, calib_folds: int = 3, oof_folds: int = 5, seed: int = 42) -> DataFrame:
    """Feature vector, label, the 3 calibration folds and the 5 out-of-fold folds."""
    return prepared(features, calib_folds, oof_folds, seed)[0]


def prepared(features: DataFrame, calib_folds: int = 3, oof_folds: int = 5, seed: int = 42) -> tuple[DataFrame, "Standardiser"]:
    """:func:`training_frame` and the standardiser fitted on it."""
    d = features.withColumn("label", F.col(LABEL).cast("double"))
    d = stratified_fold_columns(d, LABEL, KEY, {"cal_fold": calib_folds, "oof_fold": oof_folds}, seed=seed)
    d = assemble(d)
    scaler = Standardiser.fit(d, features.count())
    return scaler.transform(d), scaler


@dataclass
class Standardiser:
    """(x - mean) / population std per feature, as one vector column.

    ``StandardScaler`` (a single Summarizer pass) divides by the sample std, so
    its output is rescaled by sqrt(n / (n - 1)); a constant feature becomes 0.
    """

    scaler: object
    rescale: ElementwiseProduct

    @classmethod
    def fit(cls, df: DataFrame, n: int, col: str = "features", out: str = "features_z") -> "Standardiser":
        scaler = StandardScaler(inputCol=col, outputCol="_zs", withMean=True, withStd=True).fit(df)
        factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
        return cls(scaler, ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(FEATURES)), inputCol="_zs", outputCol=out))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.rescale.transform(self.scaler.transform(df)).drop("_zs")

    def save(self, path: str) -> None:
        self.scaler.write().overwrite().save(f"{path}/scaler")
        self.rescale.write().overwrite().save(f"{path}/rescale")

    @classmethod
    def load(cls, path: str) -> "Standardiser":
        return cls(StandardScalerModel.load(f"{path}/scaler"), ElementwiseProduct.load(f"{path}/rescale"))


def population_standardised(df: DataFrame, n: int, col: str = "features", out: str = "features_z") -> DataFrame:
    return Standardiser.fit(df, n, col, out).transform(df)


@dataclass
class BoostedTrees:
    """One fitted tree model."""

    table: TreeTable

    def predict(self, df: DataFrame, out: str = "prob") -> DataFrame:
        m = boosting.margins([self.table], vector_to_array("features"))
        return df.withColumn(out, logistic(m.getItem(0)))

    @property
    def featureImportances(self):
        return Vectors.dense(self.table.importances(len(FEATURES)).tolist())


def logistic(margin: F.Column) -> F.Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


@dataclass
class CalibratedTrees:
    """Mean over the folds of the isotonic map of each fold's tree margin."""

    members: list = field(default_factory=list)  # (TreeTable, Steps)

    def predict(self, df: DataFrame, out: str = "prob") -> DataFrame:
        members = self.members

        @F.pandas_udf("double")
        def score(xs: pd.Series) -> pd.Series:
            if not len(xs):
                return pd.Series([], dtype=float)
            x = np.stack(xs.to_numpy())
            return pd.Series(sum(steps.at(trees.margin(x)) for trees, steps in members) / len(members))

        return df.withColumn(out, score(vector_to_array("features")))


def linear_margin(model, features: str) -> F.Column:
    """x . w + b of a fitted linear model, as a column expression over its feature vector.

    (The model's own ``transform`` carries its training summary, and with it the session, into the tasks, which
    fails once the session has observed metrics.)
    """
    x = vector_to_array(features)
    total = F.lit(float(model.intercept))
    for i, w in enumerate(model.coefficients.toArray().tolist()):
        total = total + x.getItem(i) * F.lit(w)
    return total


def platt_probability(model, margin: F.Column) -> F.Column:
    return logistic(F.lit(float(model.intercept)) + margin * F.lit(float(model.coefficients[0])))


@dataclass
class CalibratedLinear:
    members: list = field(default_factory=list)  # (LogisticRegressionModel, LogisticRegressionModel on margin)

    def predict(self, df: DataFrame, out: str = "lr_prob") -> DataFrame:
        probs = [platt_probability(platt, linear_margin(lin, "features_z")) for lin, platt in self.members]
        return df.withColumn(out, sum(probs[1:], probs[0]) / F.lit(float(len(probs))))


def _parallel(tasks: list, parallelism: int) -> list:
    """Run independent fits concurrently (as CrossValidator(parallelism=k) does):
    each fit is its own chain of Spark jobs, scheduled side by side."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as ex:
        futures = [ex.submit(t) for t in tasks]
        return [f.result() for f in futures]


def _linear_member(train: DataFrame, params: LinearParams, f: int):
    def fit():
        fit_part = train.filter(F.col("cal_fold") != f)
        n = fit_part.count()
        lin = LogisticRegression(
            featuresCol="features_z", labelCol="label", regParam=1.0 / (params.C * max(n, 1)),
            elasticNetParam=0.0, standardization=False, maxIter=params.max_iter,
        ).fit(fit_part)
        m = train.filter(F.col("cal_fold") == f).select(linear_margin(lin, "features_z").alias("m"), "label")
        m = VectorAssembler(inputCols=["m"], outputCol="mv").transform(m)
        platt = LogisticRegression(featuresCol="mv", labelCol="label", regParam=0.0, maxIter=100).fit(m)
        return lin, platt

    return fit


def calibration_fits(folds: int = 3) -> list[Fit]:
    return [Fit(f"calibrated-{f}", "cal_fold", f) for f in range(folds)]


def out_of_fold_fits(folds: int = 5) -> list[Fit]:
    return [Fit(f"out-of-fold-{f}", "oof_fold", f) for f in range(folds)]


ON_EVERYTHING = Fit("raw")


@dataclass
class FittedTrees:
    calibrated: CalibratedTrees
    oof: DataFrame | None
    raw: BoostedTrees | None


def fit_all_trees(train: DataFrame, params: TreeParams, calib_folds: int = 3, oof_folds: int = 5, partitions: int | None = None) -> FittedTrees:
    """Calibrated trees, out-of-fold probabilities and (with out-of-fold fits) the trees on everything, in one pass.

    One scoring pass gives every row the margins of the models that did not see it."""
    fits = calibration_fits(calib_folds) + out_of_fold_fits(oof_folds) + ([ON_EVERYTHING] if oof_folds else [])
    tables = params.fit(train, fits, partitions)
    held = tables[: calib_folds + oof_folds]
    folds = ["cal_fold"] + (["oof_fold"] if oof_folds else [])
    m = boosting.margins(held, vector_to_array("features"))
    scored = materialize(train.select(*KEY, "label", *folds, m.alias("m")), "held-out-margins")
    own = scored.select(F.col("cal_fold").alias("fold"), F.get("m", F.col("cal_fold")).alias("margin"), "label")
    steps = fit_isotonic(own, list(range(calib_folds)))
    calibrated = CalibratedTrees([(tables[f], steps[f]) for f in range(calib_folds)])
    if not oof_folds:
        return FittedTrees(calibrated, None, None)
    prob = logistic(F.get("m", F.col("oof_fold") + calib_folds))
    return FittedTrees(calibrated, scored.select(*KEY, "label", "oof_fold", prob.alias("oof_prob")), BoostedTrees(tables[-1]))


def fit_calibrated_trees(train: DataFrame, params: TreeParams, folds: int = 3, partitions: int | None = None) -> CalibratedTrees:
    return fit_all_trees(train, params, folds, 0, partitions).calibrated


def fit_calibrated_linear(train: DataFrame, params: LinearParams, folds: int = 3, parallelism: int = 3) -> CalibratedLinear:
    return CalibratedLinear(_parallel([_linear_member(train, params, f) for f in range(folds)], parallelism))


@dataclass
class FittedModels:
    calibrated: CalibratedTrees
    linear: CalibratedLinear
    oof: DataFrame
    raw: BoostedTrees


def fit_all(train: DataFrame, params: TreeParams, linear: LinearParams | None = None,
            parallelism: int | None = None, calib_folds: int = 3, oof_folds: int = 5, partitions: int | None = None) -> FittedModels:
    """All fits of the published model stage: calibrated trees (3), out-of-fold trees (5) and full trees (1) in
    one pass, the calibrated linear fits (3) beside it."""
    tasks = [lambda: fit_all_trees(train, params, calib_folds, oof_folds, partitions)]
    tasks += [_linear_member(train, linear or LinearParams(), f) for f in range(calib_folds)]
    trees, *members = _parallel(tasks, parallelism or len(tasks))
    return FittedModels(trees.calibrated, CalibratedLinear(members), trees.oof, trees.raw)


def feature_importance(spark: SparkSession, trees) -> DataFrame:
    """(feature, importance) of a fitted tree model, most important first.

    The vector has one value per feature (21), read from the fitted model.
    """
    imp = trees.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(FEATURES, imp)], "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature").asc())


# The "worst case" conditions each route is scored under
# (PM rush on a November Wednesday, 2 degrees, 3 mm rain, wind 25, severity 2).
WORST_CASE = {
    "hour": 17, "day_of_week": 2, "month": 11, "is_weekend": 0, "is_rush_hour": 1,
    "temp_c": 2.0, "precip_mm": 3.0, "snow_cm": 0.0, "wind_kph": 25.0, "weather_severity": 2,
    "is_precipitation": 1, "is_snow": 0, "is_extreme_cold": 0, "is_high_wind": 0,
}
WORST_CASE_PERIOD = "PM Rush"


def worst_case_scores(route_risk: DataFrame, route_encoder: DataFrame, period_encoder: DataFrame,
                      model: CalibratedTrees) -> DataFrame:
    """route_risk + ml_degradation_prob_worst_case (4 decimals): one scoring pass."""
    from headway.functions.numeric import r
    from headway.operators.windows import ROUTE_FEATURES

    rr = route_risk.withColumns({v: F.coalesce(F.col(k).cast("double"), F.lit(0.0)) for k, v in ROUTE_FEATURES.items()})
    rr = rr.withColumns({k: F.lit(v) for k, v in WORST_CASE.items()})
    renc = route_encoder.select(F.col("label").alias("route"), F.col("code").alias("route_enc"))
    rr = rr.join(renc, "route", "left").withColumn("route_enc", F.coalesce("route_enc", F.lit(-1)))
    period = period_encoder.filter(F.col("label") == WORST_CASE_PERIOD).select(F.max("code")).scalar()
    rr = rr.withColumn("time_period_enc", F.coalesce(period, F.lit(0)))
    scored = model.predict(assemble(rr), "p")
    return scored.select(*route_risk.columns, r(F.col("p"), 4).alias("ml_degradation_prob_worst_case"))


def save_models(fitted: "FittedModels", path: str, encoders: dict[str, DataFrame], scaler: Standardiser) -> None:
    """Persist the calibrated trees, the calibrated linear model, the full tree model, the standardiser and
    the encoder tables under ``path`` (trees and isotonic steps as Parquet tables, the rest with Spark ML's
    writers), side by side."""
    spark = next(iter(encoders.values())).sparkSession
    tables = {f"calibrated-{i}": t for i, (t, _) in enumerate(fitted.calibrated.members)}
    jobs = [
        lambda: boosting.tree_rows(spark, {**tables, "raw": fitted.raw.table}).write.mode("overwrite").parquet(f"{path}/trees"),
        lambda: steps_rows(spark, [s for _, s in fitted.calibrated.members]).write.mode("overwrite").parquet(f"{path}/isotonic"),
        lambda: scaler.save(path),
    ]
    for i, pair in enumerate(fitted.linear.members):
        jobs += [lambda m=m, to=f"{path}/linear/{i}/{kind}": m.write().overwrite().save(to) for kind, m in zip(("model", "platt"), pair, strict=True)]
    for name, df in encoders.items():
        jobs.append(lambda df=df, to=f"{path}/encoders/{name}": df.write.mode("overwrite").parquet(to))
    _parallel(jobs, len(jobs))


@dataclass
class SavedModels:
    calibrated: CalibratedTrees
    linear: CalibratedLinear
    raw: BoostedTrees
    scaler: Standardiser
    encoders: dict[str, DataFrame]


def load_models(spark: SparkSession, path: str, folds: int = 3) -> SavedModels:
    """Inverse of :func:`save_models`; a part that is missing is an error."""
    from pyspark.ml.classification import LogisticRegressionModel

    jobs = [
        lambda: boosting.tables_of(spark.read.parquet(f"{path}/trees")),
        lambda: steps_of(spark.read.parquet(f"{path}/isotonic")),
        lambda: Standardiser.load(path),
        lambda: {name: spark.read.parquet(f"{path}/encoders/{name}") for name in ("route", "time_period")},
    ]
    jobs += [lambda to=f"{path}/linear/{i}/{kind}": LogisticRegressionModel.load(to) for i in range(folds) for kind in ("model", "platt")]
    trees, steps, scaler, encoders, *linear = _parallel(jobs, len(jobs))
    calibrated = CalibratedTrees([(trees[f"calibrated-{i}"], steps[i]) for i in range(folds)])
    return SavedModels(calibrated, CalibratedLinear(list(zip(linear[::2], linear[1::2], strict=True))), BoostedTrees(trees["raw"]), scaler, encoders)
