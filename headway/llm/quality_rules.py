"""Quality rules with thresholds that adapt to each language and source.

Every document gets text statistics; for each (lang, source) and for all documents a
quantile sketch of each ratio is kept; the thresholds come from the sketches and
are joined back for filtering.

The sketch is a histogram over logarithmic buckets: value v > 0 falls into bucket
ceil(log(v) / log(GAMMA)), zero into a bucket of its own.  Two sketches merge by
adding counts, so a sketch is one ``groupBy`` with map-side partial sums, its quantiles
are right within 1 % of the value, and they do not depend on how rows are dealt.
The number of buckets is bounded by the range of doubles, whatever the rows.

A group's limit is the upper fence of its own distribution on the logarithmic scale, q75 (q75 / q25)^FENCE.  It is
drawn towards the fence of all documents by n / (n + SHRINK), so small groups change smoothly into it, and never
passes the next fence of all documents, so that a source of junk cannot set its own limit.  No fixed cutoff
takes part beside the base rules; ratios are smoothed by fixed amounts, so that one symbol in a short text is
not a large ratio and a text without any has one.

Column expressions only, on the whole path.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.text import ASCII_SPACE, space_words, with_columns

GAMMA = 1.02
WINDOW_WORDS = 8
ZERO_BUCKET = -(2**31)
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: ratio: (numerator, denominator, added to the numerator, added to the denominator)
RATIOS = {
    "symbol_ratio": ("n_symbols", "n_words", 1, 20),
    "dup_line_ratio": ("n_dup_lines", "n_text_lines", 1, 10),
    "word_length": ("word_chars", "n_words", 0, 0),
}
FENCE = 2.5
SHRINK = 100


def _covered(first: Column, width: int) -> Column:
    """Number of positions covered by windows of ``width`` that start at the sorted positions ``first``."""
    step = F.transform(first, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(first, i + 1) - p, F.lit(width))))
    return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_text_lines (long).

    Words are ``[^\\x20\\x09-\\x0D]+``; null text has none.  n_dup_lines: lines with a
    word that equal an earlier line.  n_repeat_words: words inside 8-word windows found
    twice or more in the text.  Columns of these names are replaced.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    step = docs.select(
        F.struct("*").alias("row"),
        space_words(F.col(text)).alias("w"),
        F.filter(F.split(own, "\n", -1), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "").alias("lines"),
        F.length(F.regexp_replace(own, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    step = step.select(
        "row",
        "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_text_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    k = WINDOW_WORDS
    starts = F.when(F.size("h") >= k, F.sequence(F.lit(0), F.size("h") - k)).otherwise(F.array().cast("array<int>"))
    step = step.select("*", F.transform(starts, lambda i: F.xxhash64(F.slice("h", i + 1, k))).alias("win")).drop("h")
    step = step.select("*", (F.size("win") != F.size(F.array_distinct("win"))).alias("twice"))
    # only texts with a repeated window sort their windows
    pairs = F.array_sort(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    step = step.select("*", F.when(F.col("twice"), pairs).alias("p")).drop("win")
    same = F.filter(
        "p",
        lambda e, i: (F.get("p", i + 1)["x"].eqNullSafe(e["x"]) & (i + 1 < F.size("p"))) | ((i > 0) & F.get("p", i - 1)["x"].eqNullSafe(e["x"])),
    )
    step = step.select("*", F.array_sort(F.transform(same, lambda e: e["i"])).alias("s")).drop("p")
    step = step.select("*", F.coalesce(F.when(F.col("twice"), _covered(F.col("s"), k)), F.lit(0).cast("long")).alias("n_repeat_words")).drop("s", "twice")
    names = [*STATS, "n_text_lines"]
    out = step.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.struct(*names).alias("stats of text"))
    return with_columns(out, {c: F.col("`stats of text`").getField(c) for c in names}).drop("stats of text")


def base_failed() -> Column:
    """The fixed part of the rules, kept beside the adaptive ones."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def ratio(name: str) -> Column:
    num, den, more, of = RATIOS[name]
    return F.coalesce(F.try_divide((F.col(num) + more).cast("double"), (F.col(den) + of).cast("double")), F.lit(0.0))


def sketches(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, metric, bucket, n): the mergeable sketch of every ratio in every group, over the rows that
    the base rules keep."""
    value = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), ratio(k).alias("v")) for k in RATIOS])).alias("m")
    bucket = F.when(F.col("m.v") > 0, F.ceil(F.log(F.col("m.v")) / F.lit(math.log(GAMMA))).cast("int")).otherwise(F.lit(ZERO_BUCKET))
    return (
        measured.where(~base_failed()).select(F.col(lang).alias("lang"), F.col(source).alias("source"), value)
        .select("lang", "source", "m.metric", bucket.alias("bucket"))
        .groupBy("lang", "source", "metric", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles(sketch: DataFrame, keys: list[str], at: dict[str, float]) -> DataFrame:
    """One row for each group of ``keys`` and metric: its row count and the named quantiles (lower rank).

    ``sketch`` may hold several rows of a bucket: they are merged by adding.
    """
    by = [*keys, "metric"]
    merged = sketch.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    cum = merged.select(
        *by,
        F.when(F.col("bucket") == ZERO_BUCKET, 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1)).alias("v"),
        F.sum("n").over(Window.partitionBy(*by).orderBy("bucket")).alias("upto"),
        F.sum("n").over(Window.partitionBy(*by)).alias("rows"),
    )
    return cum.groupBy(*by).agg(
        F.max("rows").alias("rows"),
        *[F.min(F.when(F.col("upto") >= F.ceil(F.col("rows") * q), F.col("v"))).alias(k) for k, q in at.items()],
    )


def thresholds(sketch: DataFrame, fence: float = FENCE, shrink: float = SHRINK) -> DataFrame:
    """One row for each (lang, source): ``rows`` and a limit for each ratio (null where no fence can be told).

    log limit = (n * log own + shrink * log all) / (n + shrink), at most the fence of all with ``fence`` + 1,
    where own and all are q75 * (q75 / q25)^fence of the group and of all documents (q75 the upper end of
    its bucket, q25 the lower end).
    """
    at = {"q25": 0.25, "q75": 0.75}

    def log_fence(f):  # null where a quantile is 0
        # the upper end of q75's bucket and the lower end of q25's, so that a ratio that is the same
        # everywhere stays within its own fence
        a = F.when(F.col("q25") > 0, F.log(F.col("q25")) + math.log((GAMMA + 1) / 2 / GAMMA))
        b = F.when(F.col("q75") > 0, F.log(F.col("q75")) + math.log((GAMMA + 1) / 2))
        return b + f * (b - a)

    own = quantiles(sketch, ["lang", "source"], at).select("lang", "source", "metric", "rows", log_fence(fence).alias("own"))
    every = quantiles(sketch, [], at).select("metric", log_fence(fence).alias("all"), log_fence(fence + 1).alias("cap"))
    both = own.join(F.broadcast(every), "metric")  # one row for each ratio
    drawn = (F.col("rows") * F.col("own") + shrink * F.col("all")) / (F.col("rows") + shrink)
    limit = F.exp(F.least(F.coalesce(drawn, "all"), F.col("cap")))
    chosen = both.select("lang", "source", "rows", "metric", limit.alias("limit"))
    return chosen.groupBy("lang", "source").agg(F.max("rows").alias("rows"), *[F.max(F.when(F.col("metric") == k, F.col("limit"))).alias(k) for k in RATIOS])


def judge(measured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` plus base_failed and kept (boolean); no row is dropped here."""
    lim = limits.select(F.col("lang").alias("limit lang"), F.col("source").alias("limit source"), F.struct(*RATIOS).alias("limit values"))
    joined = measured.join(lim, measured[lang].eqNullSafe(lim["limit lang"]) & measured[source].eqNullSafe(lim["limit source"]), "left")
    failed = F.lit(False)
    for k in RATIOS:
        failed = failed | F.coalesce(ratio(k) > F.col("`limit values`").getField(k), F.lit(False))
    out = with_columns(joined, {"base_failed": base_failed(), "kept": ~base_failed() & ~failed})
    return out.drop("limit lang", "limit source", "limit values")


def quality_filter(measured: DataFrame, lang: str = "lang", source: str = "source", fence: float = FENCE, shrink: float = SHRINK) -> DataFrame:
    """Judged rows of ``measured`` (see ``measure``; store it first, it is read twice).

    Null languages and sources form groups of their own; empty and null texts have
    no words and fail the base rule; repeated rows count as often as they occur; an
    empty table gives an empty table.
    """
    return judge(measured, thresholds(sketches(measured, lang, source), fence, shrink), lang, source)
