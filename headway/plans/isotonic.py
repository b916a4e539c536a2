"""Isotonic regression as the lower hull of the cumulative sums, folded together range by range.

The least-squares increasing fit is the slope of the lower convex hull of the points (rows so far, label sum
so far) in score order.  The hull of all points is the hull of the hulls of their ranges, so: equal scores become one
row (a grouped sum), rows are dealt by score ranges and pooled in each range, and what is left, the corners
of the range hulls, is pooled once more.  With labels 0 and 1 a hull of N points has at most about N^(2/3)
corners (a convex polygon on a grid), so the last step sees a small share of the rows whatever the scores, and
the fitted map itself is no larger.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import materialize

BLOCKS = "fold int, lo double, hi double, y double, n long"


@dataclass
class Steps:
    """A map of scores: ``value`` at each of the ascending ``bound``, straight lines between, level outside."""

    bound: np.ndarray
    value: np.ndarray

    def at(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.bound, self.value) if len(self.bound) else np.zeros(len(score))


def pooled(blocks: pd.DataFrame) -> pd.DataFrame:
    """Adjacent violators pooled: rows (lo, hi, y, n) in score order, means y / n ascending afterwards."""
    out: list[list] = []
    for lo, hi, y, n in zip(blocks["lo"].tolist(), blocks["hi"].tolist(), blocks["y"].tolist(), blocks["n"].tolist(), strict=True):
        # means compared by cross products: label sums and counts are whole numbers
        while out and out[-1][2] * n >= y * out[-1][3]:
            a = out.pop()
            lo, y, n = a[0], a[2] + y, a[3] + n
        out.append([lo, hi, y, n])
    return pd.DataFrame(out, columns=["lo", "hi", "y", "n"])


def fit_isotonic(scored: DataFrame, folds: list[int]) -> list[Steps]:
    """The map of every fold from rows (fold, margin, label); a fold without rows maps everything to 0."""

    def ranges(batches):
        for fold, rows in pd.concat(list(batches) or [pd.DataFrame(columns=["fold"])]).groupby("fold"):
            yield pooled(rows).assign(fold=fold)[["fold", "lo", "hi", "y", "n"]]

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo")
        return pooled(pdf).assign(fold=pdf["fold"].iloc[0])[["fold", "lo", "hi", "y", "n"]]

    equal = scored.groupBy(F.col("fold").cast("int").alias("fold"), F.col("margin").alias("lo")).agg(F.max("margin").alias("hi"), F.sum("label").alias("y"), F.count("label").alias("n"))
    dealt = equal.repartitionByRange("fold", "lo").sortWithinPartitions("fold", "lo")
    corners = materialize(dealt.mapInPandas(ranges, BLOCKS), "isotonic-corners")
    steps = corners.groupBy("fold").applyInPandas(whole, BLOCKS).orderBy("fold", "lo").collect()  # the maps themselves
    out = []
    for f in folds:
        own = [r for r in steps if r.fold == f]
        bound = [b for r in own for b in ((r.lo, r.hi) if r.hi > r.lo else (r.lo,))]
        value = [r.y / r.n for r in own for _ in range(1 + (r.hi > r.lo))]
        out.append(Steps(np.array(bound, float), np.array(value, float)))
    return out


def steps_rows(spark: SparkSession, steps: list[Steps]) -> DataFrame:
    """(fold, bounds, values): what :func:`steps_of` reads."""
    rows = [(i, s.bound.tolist(), s.value.tolist()) for i, s in enumerate(steps)]
    return spark.createDataFrame(rows, "fold int, bounds array<double>, values array<double>")


def steps_of(df: DataFrame) -> list[Steps]:
    return [Steps(np.array(r.bounds, float), np.array(r["values"], float)) for r in df.orderBy("fold").collect()]
