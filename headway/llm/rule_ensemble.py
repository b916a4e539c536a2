"""Quality classifier: a sparse ensemble of rules that compiles to column expressions.

1. ``features``: statistics of the text, by column expressions.
2. A random forest over a bounded sample of labelled rows; every path from a root to a
   node is a rule, a conjunction of comparisons of statistics.
3. A lasso logistic regression over the rules keeps a few of them, with weights.
4. ``Ensemble.score`` is one column expression: the logistic function of the weighted
   sum of the rules that hold.  Scoring all documents needs no Python and no shuffle.

Labels, language, source and id are never inputs of a rule.
"""

from __future__ import annotations

import dataclasses
import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.text import ASCII_SPACE, space_words
from headway.session import materialize

FEATURES = (
    "log_words", "word_length", "symbols", "shouts", "upper", "digits", "dup_lines", "distinct", "same_as_last", "line_words", "stops", "commas",
)
#: Most labelled rows that the ensemble is fitted on.
SAMPLE_ROWS = 20_000
TREES, DEPTH, LASSO, SEED = 30, 3, 0.002, 11


def _share(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _count(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, ""))


def features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` and one double column for each statistic.

    Null and empty texts have no words; all their statistics are 0.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    step = docs.select(
        *[F.col(c) for c in keep],
        space_words(F.col(text)).alias("w of text"),
        F.filter(F.split(own, "\n", -1), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "").alias("lines of text"),
        *[_count(own, p).alias(f"{k} in text") for k, p in {"symbols": r"[^#*$%&|<>]+", "shouts": r"[^!?]+", "upper": r"[^\p{Lu}]+", "digits": r"[^0-9]+", "stops": r"[^.]+", "commas": r"[^,;:]+"}.items()],
        F.length(own).alias("chars of text"),
    )
    w, lines, n, chars = F.col("w of text"), F.col("lines of text"), F.size("w of text"), F.col("chars of text")
    of = lambda k: F.col(f"{k} in text")
    values = {
        "log_words": F.log1p(n),
        "word_length": _share(F.length(F.array_join(w, "")), n),
        "symbols": _share(of("symbols"), n),
        "shouts": _share(of("shouts"), n),
        "upper": _share(of("upper"), chars),
        "digits": _share(of("digits"), chars),
        "dup_lines": _share(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)),
        "distinct": _share(F.size(F.array_distinct(w)), n),
        "same_as_last": _share(F.size(F.filter(w, lambda x, i: (i > 0) & (F.get(w, i - 1) == x))), n),
        "line_words": _share(n, F.size(lines)),
        "stops": _share(of("stops"), n),
        "commas": _share(of("commas"), n),
    }
    return step.select(*[F.col(c) for c in keep], *[v.cast("double").alias(k) for k, v in values.items()])


@dataclasses.dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is "<=", threshold)."""

    terms: tuple[tuple[str, bool, float], ...]

    def holds(self) -> Column:
        out = F.lit(True)
        for name, le, at in self.terms:
            out = out & ((F.col(name) <= at) if le else (F.col(name) > at))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'<=' if le else '>'} {at:.6g}" for n, le, at in self.terms)


@dataclasses.dataclass(frozen=True)
class Ensemble:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1, over the columns of ``features``."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.holds(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def simplified(terms: list[tuple[str, bool, float]]) -> Rule:
    """The tightest comparison for each statistic and side, in a fixed order."""
    best: dict[tuple[str, bool], float] = {}
    for name, le, at in terms:
        had = best.get((name, le))
        best[name, le] = at if had is None else (min(had, at) if le else max(had, at))
    return Rule(tuple((n, le, best[n, le]) for n, le in sorted(best)))


def tree_rules(printed: str) -> list[Rule]:
    """Rules of all paths to nodes below the root, from a printed tree model."""
    rules, path = [], []
    for line in printed.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (FEATURES[int(m[2])], m[3] == "<=", float(m[4])))]
        rules.append(simplified([t for _, t in path]))
    return rules


def fit(rows: DataFrame, label: str, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = SEED) -> Ensemble:
    """An ensemble fitted on ``rows`` (statistics and a 0/1 label), a stored bounded sample.

    Without rows every score is 0.5; with one class it is that class's share with
    one row of each class added.
    """
    count = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    n, ones = sum(count.values()), count.get(1, 0)
    if n == 0 or ones in (0, n):
        import math

        return Ensemble((), math.log((ones + 1) / (n - ones + 1)))
    data = rows.select(F.col(label).cast("double").alias("label"), array_to_vector(F.array(*FEATURES)).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=5, subsamplingRate=0.7, featureSubsetStrategy="onethird", seed=seed).fit(data)
    rules = sorted(set(r for t in forest.trees for r in tree_rules(t.toDebugString)), key=str)
    if not rules:
        import math

        return Ensemble((), math.log((ones + 1) / (n - ones + 1)))
    held = rows.select(F.col(label).cast("double").alias("label"), array_to_vector(F.array(*[r.holds().cast("double") for r in rules])).alias("features"))
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(held)
    kept = tuple((r, float(w)) for r, w in zip(rules, lr.coefficients.toArray().tolist(), strict=True) if w)
    return Ensemble(kept, float(lr.intercept))


def training_sample(stats: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled rows with their statistics, the same ones on every run.

    Rows are taken in the order of a hash of the id; labels other than 0 and 1 and rows
    without an id are left out; an id with several rows or labels gives each pair.
    """
    own = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("label id"), F.col(label).cast("int").alias("label"))
    pairs = stats.join(own, stats[doc_id] == own["label id"]).select("label", *FEATURES, F.xxhash64("label id").alias("h"))
    return pairs.orderBy("h", "label", *FEATURES).limit(rows).drop("h")


def fit_and_score(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> tuple[DataFrame, Ensemble]:
    """(doc_id, ``learn``, score) of every row of ``docs``, and the ensemble.

    Learns from rows of ``labels`` where ``learn`` (over doc_id) is true.  Statistics are
    stored once (a few numbers a row) and read by the fit and by the scoring.
    """
    stats = materialize(features(docs, [doc_id], text), "quality-features")
    sample = materialize(training_sample(stats.where(learn), labels, label, doc_id, rows).coalesce(1), "quality-sample")
    model = fit(sample, "label")
    return stats.select(doc_id, learn.alias("learn"), model.score().alias("score")), model
