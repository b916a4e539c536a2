"""Classifier metrics and fold assignment as distributed DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.numeric import r
from headway.operators.ordinal import ordinal_within, running_sums
from headway.session import materialize


def score_counts(scored: DataFrame, score: str = "score", label: str = "label", by: list[str] | None = None) -> DataFrame:
    """(by..., score, pos, neg): one row per distinct score (partial + final aggregation)."""
    y = F.col(label).cast("int")
    return scored.groupBy(*(by or []), F.col(score).cast("double").alias("score")).agg(
        F.sum(y).cast("long").alias("pos"), F.sum(F.lit(1) - y).cast("long").alias("neg")
    )


def ranking_metrics(
    scored: DataFrame, score: str = "score", label: str = "label", places: int = 10, by: list[str] | None = None
) -> DataFrame:
    """ROC AUC and average precision from one running-count pass over distinct scores.

    With ascending running counts (inclusive) of positives and negatives,
    negatives strictly below a score = cum_neg - neg, and rows at or above it
    = totals minus the strictly-below counts.  One row: n, positives, auc, average_precision.
    """
    by = list(by or [])
    # the distinct-score table is read three times (bounds, totals, sums): stored
    counts = materialize(score_counts(scored, score, label, by), "score-counts")
    cum = running_sums(counts, "score", ["pos", "neg"], partition_cols=by, inclusive=True)
    if by:
        totals = counts.groupBy(*by).agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("_tot"))
        cum = cum.join(totals, by)  # one row per score set; AQE broadcasts it at run time
    else:
        totals = counts.select(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).scalar()
        cum = cum.withColumn("_tot", totals)
    return _ranking_from_cum(cum, places, by)


def _ranking_from_cum(cum: DataFrame, places: int, by: list[str] | None = None) -> DataFrame:
    neg_below = F.col("cum_neg") - F.col("neg")
    tp = F.col("_tot.p") - (F.col("cum_pos") - F.col("pos"))
    fp = F.col("_tot.n") - neg_below
    return cum.groupBy(*(by or [])).agg(
        (F.sum("pos") + F.sum("neg")).alias("n"),
        F.sum("pos").alias("positives"),
        (
            F.try_divide(
                (F.lit(2) * F.sum(F.col("pos") * neg_below) + F.sum(F.col("pos") * F.col("neg"))).cast("double"),
                F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double"),
            )
        ).alias("auc"),
        r(F.try_divide(F.sum(F.col("pos").cast("double") * tp / (tp + fp)), F.sum("pos")), places).alias("average_precision"),
    )


def roc_auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """ROC AUC with tied scores counted half (rank-sum / Mann-Whitney form); null
    when a class is missing.

    AUC = sum_s pos(s) * (neg below s + neg(s)/2) / (P * N), all in integer
    arithmetic until the final division.  Returns one row: n, positives, auc.
    """
    counts = materialize(score_counts(scored, score, label), "score-counts")
    cum = running_sums(counts, "score", ["neg"], inclusive=False)
    return cum.agg(
        (F.sum("pos") + F.sum("neg")).alias("n"),
        F.sum("pos").alias("positives"),
        (
            F.try_divide(
                (F.lit(2) * F.sum(F.col("pos") * F.col("cum_neg")) + F.sum(F.col("pos") * F.col("neg"))).cast("double"),
                F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double"),
            )
        ).alias("auc"),
    )


def average_precision(scored: DataFrame, score: str = "score", label: str = "label", places: int = 10) -> DataFrame:
    """Step-wise average precision: sum over distinct thresholds of
    (recall gain) x (precision at that threshold).  One row: n, positives, average_precision."""
    counts = materialize(score_counts(scored, score, label), "score-counts")
    cum = running_sums(counts, "score", ["pos", "neg"], descending=True, inclusive=True)
    total_pos = F.sum("pos")
    term = F.col("pos").cast("double") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return cum.agg(
        (F.sum("pos") + F.sum("neg")).alias("n"),
        total_pos.alias("positives"),
        r(F.try_divide(F.sum(term), total_pos), places).alias("average_precision"),
    )


def brier(scored: DataFrame, score: str = "score", label: str = "label", places: int = 10) -> DataFrame:
    """Brier score, base rate and count.  One row."""
    p, y = F.col(score).cast("double"), F.col(label).cast("double")
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        r(F.avg((p - y) * (p - y)), places).alias("brier"),
        F.avg(y).alias("base_rate"),
    )


def shuffle_key(key_cols: list[str], seed: int) -> "F.Column":
    """A seeded pseudo-random order for rows: the first 15 hex digits of
    md5("seed|k1|k2|..."), as a non-negative long (standard, engine-independent)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def stratified_fold_columns(
    df: DataFrame, label: str, key_cols: list[str], folds: dict[str, int], seed: int = 42
) -> DataFrame:
    """Several exact stratified fold assignments from one shuffled ordinal per label:
    column ``name`` = ordinal mod k for each (name, k) in ``folds``."""
    d = df.withColumn("_h", shuffle_key(key_cols, seed))
    d = ordinal_within(d, [label], "_h", tiebreak=key_cols)
    return d.withColumns({name: (F.col("ordinal") % k).cast("int") for name, k in folds.items()}).drop("_h", "ordinal")


def stratified_folds(
    df: DataFrame, label: str, key_cols: list[str], k: int = 5, seed: int = 42
) -> DataFrame:
    """Adds ``fold`` in 0..k-1: within each label, rows are shuffled by a seeded
    hash of their key and dealt round-robin, so every fold holds floor or ceil
    of n_label / k rows of each label (exact stratification).

    Positions come from bucketed running counts, never a one-task window.
    """
    d = df.withColumn("_h", shuffle_key(key_cols, seed))
    d = ordinal_within(d, [label], "_h", tiebreak=key_cols)
    return d.withColumn("fold", (F.col("ordinal") % k).cast("int")).drop("_h", "ordinal")
