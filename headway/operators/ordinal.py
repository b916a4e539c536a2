"""Distributed running sums and ordinals over a global order.

A plain ``Window.orderBy`` without a partition key moves every row into one
task.  Here rows are cut into ``buckets`` ranges of the ordering value, per-bucket
totals are prefix-summed on the small bucket table, and each bucket then runs its own
window.  The bounds are quantiles of the *distinct* values, so neither outliers nor
ties fill one bucket with distinct values; callers count equal values into one row
first (``exact_quantile`` and the metrics do), so a bucket holds about
1 / ``buckets`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 256


def _with_range_bucket(df: DataFrame, order_col: str, buckets: int, out: str) -> DataFrame:
    x = F.col(order_col).cast("double")
    at = [i / buckets for i in range(1, buckets)]
    # buckets - 1 numbers; which they are moves rows between buckets, never the result
    bounds = df.select(x.alias("x")).distinct().select(F.percentile_approx("x", at, 100 * buckets).alias("b")).scalar()
    d = df.withColumn("_bounds", F.array_distinct(bounds))  # the subquery appears once in the plan
    place = F.when(x.isNull() | F.col("_bounds").isNull(), F.lit(0)).otherwise(F.expr(_below(order_col, buckets)))
    return d.withColumn(out, place.cast("int")).drop("_bounds")


def _below(order_col: str, buckets: int) -> str:
    """SQL for the number of bounds smaller than the value: a binary search in ``_bounds``."""
    value = f"cast(`{order_col}` as double)"
    steps = buckets.bit_length()
    middle = "cast(floor((a.lo + a.hi) / 2) as int)"
    body = (
        f"if(a.lo >= a.hi, a, if(get(_bounds, {middle}) < {value}, "
        f"named_struct('lo', {middle} + 1, 'hi', a.hi), named_struct('lo', a.lo, 'hi', {middle})))"
    )
    return f"aggregate(sequence(1, {steps + 1}), named_struct('lo', 0, 'hi', size(_bounds)), (a, i) -> {body}).lo"


def running_sums(
    df: DataFrame,
    order_col: str,
    sum_cols: list[str],
    partition_cols: list[str] | None = None,
    descending: bool = False,
    inclusive: bool = True,
    buckets: int = DEFAULT_BUCKETS,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Adds ``cum_<c>`` = sum of ``c`` over rows before (and, if inclusive, at) each row
    in the order of ``order_col`` (then ``tiebreak``), within ``partition_cols``.

    Rows sharing an order value must be pre-aggregated or disambiguated by
    ``tiebreak``; every row lands in exactly one bucket so the sums are exact.
    """
    parts = list(partition_cols or [])
    ties = list(tiebreak or [])
    d = _with_range_bucket(df, order_col, buckets, "_bkt")
    if descending:
        d = d.withColumn("_bkt", F.lit(buckets - 1) - F.col("_bkt"))
    totals = d.groupBy(*parts, "_bkt").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    w_b = Window.partitionBy(*parts).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts, "_bkt", *[F.coalesce(F.sum(f"_t_{c}").over(w_b), F.lit(0)).alias(f"_o_{c}") for c in sum_cols]
    )
    # joined on the window's own partition keys: the rows are shuffled by
    # (parts, bucket) once and the window reuses that partitioning; AQE may
    # still broadcast the offsets when their run-time size is small
    d = d.join(offsets, [*parts, "_bkt"], "left")
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = Window.partitionBy(*parts, "_bkt").orderBy(o, *[F.col(t).asc() for t in ties])
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    return d.withColumns(
        {f"cum_{c}": F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0)) for c in sum_cols}
    ).drop("_bkt", *[f"_o_{c}" for c in sum_cols])


def ordinal_within(
    df: DataFrame, partition_cols: list[str], order_col: str, tiebreak: list[str] | None = None,
    buckets: int = DEFAULT_BUCKETS,
) -> DataFrame:
    """Adds ``ordinal`` = 0-based position of each row within ``partition_cols``
    in the order of (``order_col``, ``tiebreak``), computed bucket-wise."""
    d = df.withColumn("_one", F.lit(1))
    d = running_sums(d, order_col, ["_one"], partition_cols, inclusive=False, buckets=buckets, tiebreak=tiebreak)
    return d.withColumn("ordinal", F.col("cum__one").cast("long")).drop("_one", "cum__one")


def exact_quantile(df: DataFrame, col: str, q: float, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Exact quantile with linear interpolation (as ``percentile``/``quantile_cont``),
    one row ``value``, computed without gathering the values anywhere.

    ``percentile`` merges a value -> count map of every distinct value in one
    task; here the non-null values get global positions bucket-wise and only
    the (at most two) rows at positions floor/ceil((n - 1) * q) are kept.
    """
    d = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    counts = d.groupBy("v").agg(F.count(F.lit(1)).alias("n"))  # ties are one row
    ranked = running_sums(counts, "v", ["n"], inclusive=True, buckets=buckets)
    n = d.select(F.count(F.lit(1))).scalar()
    pos = ranked.withColumn("_p", (n - 1).cast("double") * F.lit(q))
    lo, hi = F.floor("_p"), F.ceil("_p")
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1  # positions of the value's rows
    at_lo, at_hi = (first <= lo) & (lo <= last), (first <= hi) & (hi <= last)
    picked = pos.filter(at_lo | at_hi).agg(
        F.max(F.when(at_lo, F.col("v"))).alias("lo"), F.max(F.when(at_hi, F.col("v"))).alias("hi"), F.max(F.col("_p") - lo).alias("frac")
    )
    return picked.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("value"))
