"""Exact grouped quantiles from value counts, in one scan.

``percentile`` over raw rows keeps a value -> count map per group in an
object aggregate, and drags every other aggregate of the same operator off
the code-generated path.  Here the rows are first reduced per (group, value)
with a plain hash aggregate (partial, map-side) that also carries the sums and
maxima the table needs; ``percentile`` with ``frequency`` and the merged sums then
come from those reduced rows -- the same multiset, so the same exact, linearly
interpolated quantiles, with one scan of the input and no join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.numeric import r
from headway.session import materialize


def grouped_quantiles(df: DataFrame, keys: list[str], qs: dict[str, float], selection: bool = False) -> DataFrame:
    """One row per group of cells: the keys and one column per named quantile of ``value``."""
    return summarise(reduced(df, keys, {}), keys, {k: Quantile(q) for k, q in qs.items()}, selection)


def reduced(df: DataFrame, keys: list[str], sums: dict[str, Column], maxima: dict[str, Column] | None = None) -> DataFrame:
    """One row per (keys, ``value``) of cells: ``n`` incidents, and the sums and maxima of the given expressions."""
    aggs = [F.sum("n").alias("n")]
    aggs += [F.sum(c).alias(k) for k, c in sums.items()] + [F.max(c).alias(k) for k, c in (maxima or {}).items()]
    return df.groupBy(*keys, "value").agg(*aggs)


def quantile(q: float) -> Column:
    """An exact quantile of ``value`` over rows of :func:`reduced`."""
    return F.percentile(F.col("value"), F.lit(float(q)), F.col("n"))


@dataclass(frozen=True)
class Quantile:
    """A column of :func:`summarise`: the exact quantile of ``value``, rounded to ``places``."""

    q: float
    places: int | None = None


#: Different values of a group that one task may gather; beyond it ranks are searched for.
GATHERED = 100_000
BUCKETS = 4096


def many_values(cells: DataFrame, limit: int = GATHERED) -> bool:
    """Whether any group could have more than ``limit`` different values (one count over all cells)."""
    return cells.select("value").distinct().limit(limit + 1).count() > limit


def summarise(rows: DataFrame, keys: list[str], columns: dict[str, Column | Quantile], selection: bool = False) -> DataFrame:
    """One row per group of :func:`reduced` rows with the given aggregates, in their order.

    Quantiles come from the same aggregate, which gathers a group's (value, count) pairs in one task; with
    ``selection`` from :func:`selected_quantiles`, which gathers no group.  The results are equal.
    """
    rounded = lambda c, q: r(c, q.places) if q.places is not None else c
    if not selection:
        return rows.groupBy(*keys).agg(*[(rounded(quantile(c.q), c) if isinstance(c, Quantile) else c).alias(k) for k, c in columns.items()])
    rows = materialize(rows, "group-values")
    plain = [c.alias(k) for k, c in columns.items() if not isinstance(c, Quantile)]
    base = rows.groupBy(*keys).agg(*plain) if plain else rows.select(*keys).distinct()
    wanted = {k: c for k, c in columns.items() if isinstance(c, Quantile)}
    found = selected_quantiles(rows, keys, {k: c.q for k, c in wanted.items()})
    right = found.select(F.struct(*keys).alias("_group"), *wanted)
    out = base.withColumn("_group", F.struct(*keys)).join(right, "_group")
    return out.select(*keys, *[rounded(F.col(k), wanted[k]).alias(k) if k in wanted else k for k in columns])


def selected_quantiles(rows: DataFrame, keys: list[str], qs: dict[str, float], gathered: int = GATHERED, buckets: int = BUCKETS) -> DataFrame:
    """Exact, linearly interpolated quantiles of every group of (keys, value, n) rows, without gathering a group.

    A quantile needs the values of one or two ranks.  All ranks of all groups are searched for together: each
    round cuts the range that still holds a rank into ``buckets`` parts, counts the rows in them (partial sums
    before the shuffle, at most ``buckets`` rows a rank) and goes on with the part that holds the rank, shrunk to the
    values in it.  A rank is found when its part holds one value; parts of at most ``gathered`` different
    values are looked through directly.  ``rows`` has one row for each value of a group, as :func:`reduced` gives
    them; store it, every round reads it.  Null values are left out, as
    ``percentile`` does; a group of nulls only has null quantiles; null keys are groups of their own.
    """
    grouped = rows.select(F.struct(*keys).alias("group"), "value", "n").where(F.col("value").isNotNull() & (F.col("n") > 0))
    size = grouped.groupBy("group").agg(F.sum("n").alias("rows"), F.min("value").alias("a"), F.max("value").alias("b"), F.count("value").alias("d"))
    names = list(qs)
    at = [F.struct(F.lit(i).alias("q"), ((F.col("rows") - 1) * F.lit(float(qs[k]))).alias("position")) for i, k in enumerate(names)]
    wanted = size.select("group", "a", "b", "d", F.explode(F.array(*at)).alias("w"))
    ranks = wanted.select("group", "a", "b", "d", "w.q", "w.position", F.explode(F.array_distinct(F.array(F.floor("w.position"), F.ceil("w.position")))).alias("rank"))
    wanted = materialize(ranks.select("group", "q", "position", "rank"), "quantile-ranks")
    # the same rank is searched for once, whichever quantiles ask for it
    search = materialize(ranks.groupBy("group", F.col("rank").alias("target")).agg(F.first("rank").alias("rank"), F.first("a").alias("a"), F.first("b").alias("b"), F.first("d").alias("d")), "quantile-search")
    found = []
    while True:
        found.append(search.where(F.col("a") == F.col("b")).select("group", "target", F.col("a").alias("value")))
        search = search.where(F.col("a") < F.col("b"))
        small = search.where(F.col("d") <= gathered)
        inside = grouped.join(small, "group").where(F.col("value").between(F.col("a"), F.col("b")))
        upto = F.sum("n").over(Window.partitionBy("group", "target").orderBy("value"))
        found.append(inside.select("group", "target", "value", "rank", upto.alias("upto")).where(F.col("upto") > F.col("rank")).groupBy("group", "target").agg(F.min("value").alias("value")))
        search = search.where(F.col("d") > gathered)
        if search.isEmpty():
            break
        inside = grouped.join(search.drop("d"), "group").where(F.col("value").between(F.col("a"), F.col("b")))
        part = F.least(F.floor((F.col("value") - F.col("a")) / (F.col("b") - F.col("a")) * buckets), F.lit(buckets - 1))
        counts = inside.groupBy("group", "target", "rank", part.alias("part")).agg(F.sum("n").alias("n"), F.min("value").alias("a"), F.max("value").alias("b"), F.count("value").alias("d"))
        w = Window.partitionBy("group", "target").orderBy("part")
        counts = counts.withColumn("upto", F.sum("n").over(w)).withColumn("before", F.col("upto") - F.col("n"))
        held = counts.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))
        search = materialize(held.select("group", "target", (F.col("rank") - F.col("before")).alias("rank"), "a", "b", "d"), "quantile-search")
    values = found[0]
    for f in found[1:]:
        values = values.unionByName(f)
    values = materialize(values, "quantile-values")
    ends = wanted.join(values.withColumnRenamed("target", "rank"), ["group", "rank"]).groupBy("group", "q").agg(
        F.first("position").alias("position"), F.min_by("value", "rank").alias("low"), F.max_by("value", "rank").alias("high")
    )
    share = F.col("position") - F.floor("position")
    exact = ends.select("group", "q", F.when(F.col("low") == F.col("high"), F.col("low").cast("double")).otherwise((1 - share) * F.col("low") + share * F.col("high")).alias("v"))
    wide = exact.groupBy("group").agg(*[F.max(F.when(F.col("q") == i, F.col("v"))).alias(k) for i, k in enumerate(names)])
    every = rows.select(F.struct(*keys).alias("group")).distinct().join(wide, "group", "left")
    return every.select("group.*", *names)


def ratio(total: str, count: str = "n") -> Column:
    """Sum over sum: the mean of what ``total`` adds up."""
    return F.try_divide(F.sum(total).cast("double"), F.sum(count).cast("double"))
