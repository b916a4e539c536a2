"""Exact deduplication with the heavy hitters split off.

1. Every text gets a digest (SHA-256, its length and a second hash beside it); digests are stored, texts move
   no further.
2. A Misra-Gries summary of the digests (the engine's frequent-items sketch, a Misra-Gries summary of weighted
   counters) is made in every map task and merged: at most TRACKED counters, whatever the rows.  It names at
   most HEAVY digests; one that it leaves out has at most about 3.5 / TRACKED of all rows.
3. The named digests are verified: one more pass counts them exactly and finds the row that stays.  The
   summary only says where to look, so a wrong guess costs nothing but its row.
4. These winners, at most HEAVY rows, are broadcast: the rows of the largest groups are marked where they
   are and are never shuffled.
5. The other digests take an ordinary shuffle, pre-aggregated; groups of one row never meet the join.

Column expressions only, on the whole path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.session import materialize

TRACKED = 4096
#: Bound of the broadcast winners.
HEAVY = 1024
KEY = ["text_sha256", "length", "second"]


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_sha256 (of the UTF-8 text, null as empty), and its length and second hash."""
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    step = docs.select(F.col(doc_id).alias("doc_id"), own.alias("own"))
    return step.select("doc_id", F.sha2("own", 256).alias("text_sha256"), F.octet_length("own").alias("length"), F.xxhash64("own").alias("second"))


def heavy_hitters(keyed: DataFrame, column: str = "text_sha256", most: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """At most ``most`` values of ``column`` that a merged Misra-Gries summary of ``tracked`` counters holds."""
    top = keyed.agg(F.expr(f"approx_top_k(`{column}`, {int(most)}, {int(tracked)})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias(column))


def _winners(keyed: DataFrame) -> DataFrame:
    """One row for each group of equal texts: the largest id and the number of rows."""
    return keyed.groupBy(*KEY).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical; null counts as empty.  Of equal texts the row with the largest
    id stays.  Rows without an id stay only where no row of the group has one; rows that repeat both the id
    and the text that stay are all marked as kept (``drop_exact_duplicates`` leaves one of them).  Rows that
    share an id with another text belong to that text's group.  An empty table gives an empty table; other
    columns are left out, whatever their names.
    """
    keyed = materialize(digests(docs, doc_id, text), "exact-digests")
    named = materialize(heavy_hitters(keyed, "text_sha256", most, tracked), "exact-heavy")
    # both broadcasts hold at most ``most`` rows of fixed width
    verified = _winners(keyed.join(F.broadcast(named), "text_sha256", "left_semi")).where(F.col("group_size") > 1)
    verified = materialize(verified, "exact-winners")
    hot = keyed.join(F.broadcast(verified), KEY)

    # stored, so that both sides of the join come straight from a shuffle and skewed ones can be split
    rest = keyed.join(F.broadcast(verified.select(*KEY)), KEY, "left_anti")
    repeated = materialize(_winners(rest).where(F.col("group_size") > 1), "exact-repeated")
    cold = rest.join(repeated, KEY, "left")

    single = F.col("group_size").isNull()
    out = hot.unionByName(cold).select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "text_sha256",
    )
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row of ``docs`` for each different text, with all its columns; cases as in ``exact_duplicates``."""
    marks = exact_duplicates(docs, doc_id, text, most, tracked)
    stay = marks.where("kept").select(F.col("doc_id").alias("kept id"), F.col("text_sha256").alias("kept digest"), (F.col("group_size") > 1).alias("kept of many")).distinct()
    own = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("own id"), F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256).alias("own digest"))
    met = own.join(stay, F.col("own id").eqNullSafe(F.col("kept id")) & (F.col("own digest") == F.col("kept digest")))
    one = met.where("`kept of many`").dropDuplicates(["own id", "own digest"])
    return met.where("not `kept of many`").unionByName(one).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
