"""Boosted trees for binary labels, any number of fits in one pass over the rows.

The published pipeline fits the same trees nine times (three calibration folds, five out-of-fold, one on
everything).  Here the nine grow side by side: rows are binned once and stay in executor memory with the
margins of all fits; each level of the nine current trees is *one* job that adds up counts, residuals and
curvatures by (fit, node, feature, bin) in every partition, merges the sums of a fit in one task and chooses the
splits there.  The driver sees the choices only (a few numbers for each fit and node, however many rows,
partitions, features and bins there are) and sends them back.

Results do not depend on partitions or file layout: bin borders come from rows chosen by a hash of their key,
a tree's row sample is a hash of (row, fit, tree), and sums are added as integers (residuals in
fixed point), so their order does not matter.

Trees follow the published formulation: margins start at the log-odds, a tree is fitted to the residuals with the
improvement n_l n_r / (n_l + n_r) (mean_l - mean_r)^2, leaves are sum(residual) / sum(p (1 - p)).

The rows with their margins are an RDD, persisted and checkpointed every CHECKPOINT_TREES trees: the job is
imperative work on whole partitions (arrays over all rows), which the DataFrame API has no form for.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import ensure_checkpoint_dir

#: Rows from which bin borders are taken (all rows when there are no more).
BORDER_ROWS = 20_000
#: Rows of a block while fitting; a partition holds one, or several where there are more blocks than cores.  Fewer rows
#: are added up by one task sooner than sums of several tasks are shuffled.
ROWS_PER_BLOCK = 20_000
CHECKPOINT_TREES = 25
#: Fixed point of residuals and curvatures: sums of 8 billion rows fit 64 bits.
SCALE = float(1 << 30)


@dataclass(frozen=True)
class Fit:
    """One fit: the rows whose ``column`` is not ``fold`` (all rows without a column)."""

    name: str
    column: str | None = None
    fold: int = -1


@dataclass
class TreeTable:
    """The trees of one fit as arrays [tree, node]; node i has children 2 i + 1 and 2 i + 2.

    ``feature`` is -1 at leaves; rows with x <= threshold go left.
    """

    start: float
    step: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Margins of the rows of ``x`` [row, feature]; the same for a row in whatever batch it comes."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = (self.feature.shape[1] + 1).bit_length() - 2
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                f = self.feature[t, node]
                node = np.where(f < 0, node, 2 * node + 1 + (x[rows, np.maximum(f, 0)] > self.threshold[t, node]))
            out += self.step * self.value[t, node]
        return out

    def importances(self, n_features: int) -> np.ndarray:
        """Share of each feature in the improvement of all splits."""
        total = np.bincount(np.maximum(self.feature, 0).ravel(), weights=self.gain.ravel(), minlength=n_features)
        return total / total.sum() if total.sum() > 0 else total


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-m))


def borders(rows: DataFrame, max_bins: int, limit: int = BORDER_ROWS) -> list[np.ndarray]:
    """Thresholds of every feature from at most about ``limit`` rows, those with the smallest key hash.

    ``rows``: key (hash), x (array of features).  Few different values: half way between neighbours;
    many: quantiles.
    """
    n = rows.count()
    # hashes are uniform, so this share of their range holds about ``limit`` rows
    share = min(int(min(1.0, limit / max(n, 1)) * 2**32) * 2**32 - 2**63, 2**63 - 1)
    x = np.array([r.x for r in rows.where(F.col("key") <= F.lit(share)).select("x").toLocalIterator()], float)
    out = []
    for column in x.T if len(x) else []:
        values = np.unique(column)
        if len(values) > max_bins:
            values = np.unique(np.quantile(column, np.arange(1, max_bins + 1) / max_bins, method="inverted_cdf"))
        out.append((values[:-1] + values[1:]) / 2)
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sampled(key: np.ndarray, seed: int, fit: int, tree: int, share: float) -> np.ndarray:
    """Whether each row (by its key's hash) is in the sample of a tree."""
    salt = np.uint64((seed * 1_000_003 + fit * 8191 + tree * 0x9E3779B97F4A7C15 + 1) % 2**64)
    return _mixed(_mixed(key + salt) ^ salt) < np.uint64(min(int(share * 2**64), 2**64 - 1))


@dataclass
class _Block:
    """Rows that are worked on at once: bins [row, feature], label, key, membership and margins [row, fit]."""

    bins: np.ndarray
    label: np.ndarray
    key: np.ndarray
    member: np.ndarray
    margin: np.ndarray | None = None


def _descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    for _ in range(levels):
        f = feature[node]
        node = np.where(f < 0, node, 2 * node + 1 + (bins[rows, np.maximum(f, 0)] > cut[node]))
    return node


def _sums(blocks: Iterable[_Block], feature, cut, level: int, tree: int, seed: int, share: float, n_bins: int):
    """(fit, [3, node of the level, feature, bin]) of a partition: counts, residuals and curvatures in fixed point."""
    total = None
    for block in blocks:
        sums = _block_sums(block, feature, cut, level, tree, seed, share, n_bins)
        total = sums if total is None else total + sums
    if total is not None:
        yield from ((f, total[:, f]) for f in range(total.shape[1]))


def _block_sums(block: _Block, feature, cut, level: int, tree: int, seed: int, share: float, n_bins: int) -> np.ndarray:
    """[3, fit, node of the level, feature, bin]: counts, residuals and curvatures in fixed point."""
    n_fits, n_features = block.member.shape[1], block.bins.shape[1]
    first, width = (1 << level) - 1, 1 << level
    out = np.zeros((3, n_fits, width * n_features * n_bins), np.int64)
    offset = np.arange(n_features, dtype=np.int64) * n_bins
    for f in range(n_fits):
        rows = np.flatnonzero(block.member[:, f] & sampled(block.key, seed, f, tree, share))
        node = _descend(block.bins[rows], feature[f], cut[f], level) - first
        live = node >= 0  # the others have come to a leaf
        rows, node = rows[live], node[live]
        p = sigmoid(block.margin[rows, f])
        at = (node[:, None] * (n_features * n_bins) + offset + block.bins[rows]).ravel()
        size = width * n_features * n_bins
        out[0, f] = np.bincount(at, minlength=size)
        for k, v in ((1, block.label[rows] - p), (2, p * (1 - p))):
            # whole numbers under 2^53: exact as doubles
            out[k, f] = np.bincount(at, weights=np.repeat(np.rint(v * SCALE), n_features), minlength=size).astype(np.int64)
    return out.reshape(3, n_fits, width, n_features, n_bins)


def _best(sums: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """For each node of ``sums`` [3, node, feature, bin]: gain, feature, bin of the best split (gain <= 0: none), and
    (n, r, h) of both sides and of the node."""
    left = np.cumsum(sums, axis=-1)
    total = left[..., :1, -1:]  # any feature's total
    right = total - left
    n_l, n_r = left[0].astype(float), right[0].astype(float)
    ok = (left[0] >= max(min_leaf, 1)) & (right[0] >= max(min_leaf, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = n_l * n_r / (n_l + n_r) * (left[1] / n_l - right[1] / n_r) ** 2
    gain = np.where(ok, gain / SCALE**2, 0.0)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=-1)
    value = np.take_along_axis(flat, at[:, None], -1)[:, 0]
    pick = lambda a: np.take_along_axis(a.reshape(3, len(gain), -1), at[None, :, None], -1)[..., 0]
    return value, at // gain.shape[-1], at % gain.shape[-1], pick(left), pick(right), total[..., 0, 0]


def _leaf(r, h):
    return np.where(h > 0, r / np.maximum(h, 1), 0.0)


def fit_trees(
    train: DataFrame,
    key: list[str],
    fits: list[Fit],
    n_trees: int,
    step: float,
    depth: int,
    subsample: float,
    min_leaf: int,
    seed: int,
    max_bins: int,
    label: str = "label",
    features: str = "features",
    partitions: int | None = None,
) -> list[TreeTable]:
    """The trees of every fit over the rows of ``train`` (key columns, label 0/1, feature vector, fold columns).

    Rows that share a key fall into the same samples.  A fit without rows, or with one class, gives trees
    without splits.  ``partitions`` (default: rows / ROWS_PER_BLOCK, but one for each core at most) changes the
    speed only.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    folds = sorted({f.column for f in fits if f.column})
    rows = train.select(F.xxhash64(*key).alias("key"), F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"), *[F.col(c).cast("int") for c in folds]).persist()
    try:
        edges = borders(rows, max_bins)
        n, n_features = rows.count(), len(edges)
        if not n:
            return [TreeTable(0.0, step, *_blank(n_trees, depth)) for _ in fits]
        if not partitions:
            partitions = max(1, min(spark.sparkContext.defaultParallelism, n // ROWS_PER_BLOCK))
        n_bins = 1 + max((len(e) for e in edges), default=0)
        wanted = [(folds.index(f.column) if f.column else -1, f.fold) for f in fits]

        def block(batches):
            parts = [[], [], [], []]

            def packed():
                rows = pickle.dumps([np.concatenate(p) for p in parts])
                for p in parts:
                    p.clear()
                return pd.DataFrame({"block": [rows]})

            for pdf in batches:
                x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, n_features))
                bins = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]
                parts[0].append(np.stack(bins, axis=1).astype(np.uint8 if n_bins <= 256 else np.int32))
                parts[1].append(pdf["y"].to_numpy(float))
                parts[2].append(pdf["key"].to_numpy(np.int64).view(np.uint64))
                parts[3].append(np.array([np.ones(len(pdf), bool) if c < 0 else pdf[folds[c]].to_numpy() != v for c, v in wanted]).T)
                if sum(map(len, parts[1])) >= ROWS_PER_BLOCK:
                    yield packed()
            if sum(map(len, parts[1])):
                yield packed()

        blocks = rows.repartition(partitions, "key").mapInPandas(block, "block binary")
        static = blocks.rdd.map(lambda r: _Block(*pickle.loads(r.block))).persist(StorageLevel.MEMORY_AND_DISK)
        base = static.map(lambda b: np.stack([b.member.sum(axis=0), (b.member * b.label[:, None]).sum(axis=0)])).reduce(np.add)
        share = np.where(base[0] > 0, base[1] / np.maximum(base[0], 1), 0.5)
        flat = (share <= 0) | (share >= 1)  # one class: the margin says so and no tree can add to it
        limit = np.finfo(float).eps
        start = np.log(np.clip(share, limit, 1 - limit) / (1 - np.clip(share, limit, 1 - limit)))
        tables = _grow(static, start, flat, edges, fits, n_trees, step, depth, subsample, min_leaf, seed, n_bins)
        static.unpersist()
    finally:
        rows.unpersist()
    return tables


def _blank(n_trees: int, depth: int) -> tuple[np.ndarray, ...]:
    """feature, threshold, value and gain of trees without splits."""
    shape = (n_trees, (1 << (depth + 1)) - 1)
    return np.full(shape, -1, np.int64), np.zeros(shape), np.zeros(shape), np.zeros(shape)


def _grow(static, start, flat, edges, fits, n_trees, step, depth, subsample, min_leaf, seed, n_bins) -> list[TreeTable]:
    n_fits = len(fits)
    feature, threshold, value, gain = (np.stack([a] * n_fits) for a in _blank(n_trees, depth))
    cut = np.zeros(feature.shape, np.int64)  # the bin that stands for the threshold
    parts = static.getNumPartitions()

    def begin(b):
        return replace(b, margin=np.repeat(start[None, :], len(b.label), axis=0))

    def advance(b, f, c, v):
        more = np.stack([step * v[j][_descend(b.bins, f[j], c[j], depth)] for j in range(n_fits)], axis=1)
        return replace(b, margin=b.margin + more)

    state, had = static.map(begin).persist(StorageLevel.MEMORY_AND_DISK), None
    for t in range(n_trees):
        if t:
            f, c, v = feature[:, t - 1].copy(), cut[:, t - 1].copy(), value[:, t - 1].copy()
            had, state = state, state.map(lambda b, f=f, c=c, v=v: advance(b, f, c, v)).persist(StorageLevel.MEMORY_AND_DISK)
            if t % CHECKPOINT_TREES == 0:
                state.checkpoint()  # with the next job; cuts the lineage of the margins
        for level in range(depth):
            f, c = feature[:, t].copy(), cut[:, t].copy()
            sums = state.mapPartitions(lambda bs, f=f, c=c, level=level, t=t: _sums(bs, f, c, level, t, seed, subsample, n_bins))
            if parts > 1:
                sums = sums.reduceByKey(np.add, min(n_fits, parts))
            found = sums.mapValues(lambda s: _best(s, min_leaf)).collectAsMap()  # bounded: fits x nodes
            if had is not None:
                had.unpersist()
                had = None
            best, at, bin_, left, right, total = (np.stack(x, axis=-2) for x in zip(*(found[i] for i in range(n_fits)), strict=True))
            if level == 0:
                root = np.maximum(total[0, :, :1].astype(float), 1)
                value[:, t, 0] = _leaf(total[1, :, 0], total[2, :, 0])
            go = (best > 1e-12) & ~flat[:, None]
            here = np.arange((1 << level) - 1, (2 << level) - 1)
            feature[:, t, here] = np.where(go, at, -1)
            cut[:, t, here] = np.where(go, bin_, 0)
            gain[:, t, here] = np.where(go, best / root, 0.0)
            for side, s in ((1, left), (2, right)):
                value[:, t, 2 * here + side] = np.where(go, _leaf(s[1], s[2]), 0.0)
            if not go.any():
                break
        value[flat, t] = 0.0
    state.unpersist()
    for j, e in enumerate(edges):
        own = feature == j
        threshold[own] = e[cut[own]]
    return [TreeTable(float(start[i]), step, feature[i], threshold[i], value[i], gain[i]) for i in range(n_fits)]


def tree_rows(spark: SparkSession, tables: dict[str, TreeTable]) -> DataFrame:
    """One row for each tree of each named fit (bounded by fits x trees): what :func:`tables_of` reads."""
    schema = "fit string, tree int, start double, step double, feature array<int>, threshold array<double>, value array<double>, gain array<double>"
    rows = [
        (name, i, t.start, t.step, t.feature[i].tolist(), t.threshold[i].tolist(), t.value[i].tolist(), t.gain[i].tolist())
        for name, t in tables.items()
        for i in range(len(t.feature))
    ]
    return spark.createDataFrame(rows, schema)


def tables_of(df: DataFrame) -> dict[str, TreeTable]:
    by_fit: dict[str, list] = {}
    for r in df.orderBy("fit", "tree").collect():  # bounded: fits x trees rows
        by_fit.setdefault(r.fit, []).append(r)
    return {
        name: TreeTable(rs[0].start, rs[0].step, *(np.array([r[c] for r in rs], kind) for c, kind in (("feature", np.int64), ("threshold", float), ("value", float), ("gain", float))))
        for name, rs in by_fit.items()
    }


def margins(tables: list[TreeTable], x: Column) -> Column:
    """Array column: the margin of each of ``tables`` for the feature array ``x``."""

    @F.pandas_udf("array<double>")
    def score(xs: pd.Series) -> pd.Series:
        if not len(xs):
            return pd.Series([], dtype=object)
        m = np.stack(xs.to_numpy())
        return pd.Series(list(np.stack([t.margin(m) for t in tables], axis=1)))

    return score(x)
