"""Line deduplication: a line found in many documents stays in one of them.

Lines are exploded, normalised and hashed; the distinct documents of each hash are
counted; lines of hashes over the threshold are dropped and each document is put
together again by position.  Only hashes and positions are shuffled for the count;
the texts move once, when a document meets the positions it loses.

Hot lines: the distinct count is pre-aggregated before its shuffle; the repeated keys are
stored, so that both sides of the join of lines with them come straight from a shuffle and
adaptive execution splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.text import ascii_lower, ascii_strip, hash128, with_columns
from headway.session import materialize


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_chars: int = 20,
    min_docs: int = 3,
) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, plus ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line stripped of ASCII white space at both ends with A-Z
    lower-cased.  Keys of at least ``min_chars`` code points held by at least
    ``min_docs`` distinct ids stay only in the largest id that holds them (all their
    lines there); every other document loses all their lines.

    Null or empty text: one empty line, and the text stays as it is when nothing is
    dropped.  Rows without an id count together as one document that is smaller
    than every other.  Repeated rows: equal ids are one document for the count and
    every row is treated by itself.  Columns named like the added ones are replaced;
    any other column is carried along.  An empty table gives an empty table.
    """
    base = docs.select(
        F.struct("*").alias("row"),
        F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("th"),
        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1).alias("lines"),
    )
    line = base.select("id", "th", F.posexplode("lines").alias("pos", "line"))
    norm = line.select("id", "th", "pos", ascii_lower(ascii_strip(F.col("line"))).alias("norm"))
    h1, h2 = hash128(F.col("norm"))
    keyed = norm.where(F.char_length("norm") >= min_chars).select("id", "th", "pos", h1.alias("h1"), h2.alias("h2"))

    repeated = materialize(
        keyed.groupBy("h1", "h2")
        .agg(F.count_distinct(F.struct("id")).alias("n"), F.max("id").alias("keep"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "keep"),
        "line-repeated",
    )
    drops = (
        keyed.join(repeated, ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("keep")))
        .groupBy("id", "th")
        .agg(F.collect_set("pos").alias("drop"))
    )
    b, d = base.alias("b"), drops.alias("d")
    joined = b.join(d, F.col("b.id").eqNullSafe(F.col("d.id")) & F.col("b.th").eqNullSafe(F.col("d.th")), "left").select(
        "row", "lines", "drop"
    )
    n = F.size("lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drop"))
    joined = joined.select(
        "row",
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNotNull(), F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")).alias("rest"),
    )
    n_dropped = F.greatest(F.col("n_dropped"), F.lit(0))  # size(null) is -1 in some modes
    field = [F.col("row").getField(c) for c in docs.columns]
    out = joined.select(*[f.alias(c) for f, c in zip(field, docs.columns, strict=True)], F.struct("n_lines", n_dropped.alias("n_dropped"), "rest").alias("line_dedup"))
    new = F.coalesce(F.col("line_dedup.rest"), F.col(text))
    out = out.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns], "line_dedup")
    return with_columns(out, {"n_lines": F.col("line_dedup.n_lines"), "n_dropped": F.col("line_dedup.n_dropped")}).drop("line_dedup")
