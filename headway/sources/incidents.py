"""Incident files: multi-file CSV scan by year, all-text schema, and an incremental Parquet cache."""

from __future__ import annotations

import csv
import logging
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.operators.clean import RENAMES
from headway.operators.joins import checked_broadcast
from headway.session import materialize, remove_path

log = logging.getLogger(__name__)

READABLE = (".csv", ".csv.gz")
KNOWN = (*READABLE, ".xlsx", ".xls")
#: Different header lines in one read; the driver sees these, never one entry a file.
MAX_LAYOUTS = 1000


@dataclass(frozen=True)
class SourceFile:
    path: str
    length: int
    modified: int


def _file_system(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_source_files(spark: SparkSession, root: str, years: list[int] | None = None) -> list[SourceFile]:
    """Files under ``root`` of a known format whose lower-cased name contains one of ``years``, in name order.

    Listing goes through the Hadoop file system, so any cluster storage works.
    """
    years = years or [2024]
    path, fs = _file_system(spark, root)
    out = []
    for st in fs.listStatus(path):
        low = st.getPath().getName().lower()
        if st.isFile() and low.endswith(KNOWN) and any(str(y) in low for y in years):
            out.append(SourceFile(st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return sorted(out, key=lambda f: f.path)


def list_incident_files(spark: SparkSession, root: str, years: list[int] | None = None) -> list[str]:
    return [f.path for f in list_source_files(spark, root, years)]


# ------------------------------------------------------------------ records
# A line's effect on "inside a quoted field" depends on whether that holds where it begins.  Both answers
# come from its text alone, so splits are read independently and their answers are chained afterwards.
_FIELD = r'"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|'
_OPENS = rf'(?:(?:{_FIELD}),)*+"(?:[^"]++|"")*+'
OPEN_FROM_CLOSED = rf"^{_OPENS}$"
OPEN_FROM_OPEN = rf'^(?:[^"]++|"")*+(?:$|"[^,]*+,{_OPENS}$)'


def _ends_open(line: Column, begins_open: bool) -> Column:
    """Whether a quoted field goes on after ``line``, given whether one goes on before it."""
    return F.when(line.contains('"'), line.rlike(OPEN_FROM_OPEN if begins_open else OPEN_FROM_CLOSED)).otherwise(F.lit(begins_open))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, row, value): text lines; files are split, rows are in order within a block."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.when(F.col("_metadata.file_block_start") == 0, F.ltrim(F.col("value"), F.lit("﻿"))).otherwise(F.col("value")).alias("value"),
    )


def _blank(line: Column) -> Column:
    return F.trim(line) == ""


def _first_lines(lines: DataFrame) -> DataFrame:
    """(file, header, broken) of every file with a line: its first line that is not blank, and whether any line
    could leave a quoted field open.  One scan, partial aggregates, one row a file."""
    head = (F.col("block") == 0) & ~_blank(F.col("value"))
    return lines.groupBy("file").agg(
        F.min_by(F.when(head, F.col("value")), F.when(head, F.col("row"))).alias("header"),
        F.max(_ends_open(F.col("value"), False)).alias("broken"),
    )


def _chained(state_if_closed: str, state_if_open: str, over: Window) -> tuple[Column, Column]:
    """The state after each row of ``over`` from either state before its first row.

    A row either sets the state (both answers equal), keeps it or flips it: what counts is the last row that
    sets it and the flips since.
    """
    sets = F.col(state_if_closed) == F.col(state_if_open)
    flips = F.sum((F.col(state_if_closed) & ~F.col(state_if_open)).cast("int")).over(over)
    last = F.last(F.when(sets, F.struct(F.col(state_if_closed).alias("to"), F.col("flips").alias("flips"))), ignorenulls=True)
    return flips, last


def _after(begins_open: Column) -> Column:
    odd = (F.col("flips") - F.coalesce(F.col("set.flips"), F.lit(0))) % 2 == 1
    return F.coalesce(F.col("set.to"), begins_open) != odd


def _whole_records(lines: DataFrame) -> DataFrame:
    """Records of files in which quoted fields go on over line breaks: (file, block, row, value) by their first line.

    Each block answers for both states it may begin in; one row a block is chained along its file; blocks then
    know their state, and lines that continue a record are put behind its first line.  A block is never
    larger than a split; only these files are shuffled.
    """
    inside = Window.partitionBy("file", "block").orderBy("row")
    answered = lines.withColumns({"c": _ends_open(F.col("value"), False), "o": _ends_open(F.col("value"), True)})
    flips, last = _chained("c", "o", inside)
    chained = answered.withColumn("flips", flips).withColumn("set", last.over(inside))
    chained = chained.withColumns({"c": _after(F.lit(False)), "o": _after(F.lit(True))})  # after this line, from the block's beginning
    chained = materialize(chained.select("file", "block", "row", "value", "c", "o"), "csv-lines")

    blocks = chained.groupBy("file", "block").agg(F.max_by("c", "row").alias("c"), F.max_by("o", "row").alias("o"))
    along = Window.partitionBy("file").orderBy("block")
    flips, last = _chained("c", "o", along)
    blocks = blocks.withColumn("flips", flips).withColumn("set", last.over(along)).withColumn("after", _after(F.lit(False)))
    blocks = materialize(blocks.select("file", "block", "after", F.coalesce(F.lag("after").over(along), F.lit(False)).alias("begins")), "csv-blocks")
    bad = blocks.groupBy("file").agg(F.max_by("after", "block").alias("after")).where("after").select("file").take(3)
    if bad:
        raise ValueError(f"a quoted field is never closed in {[r.file for r in bad]}")

    state = chained.join(blocks.select("file", "block", "begins"), ["file", "block"])
    after = F.when(F.col("begins"), F.col("o")).otherwise(F.col("c"))
    state = state.withColumn("before", F.coalesce(F.lag(after).over(inside), F.col("begins")))
    first = F.last(F.when(~F.col("before"), F.col("row")), ignorenulls=True).over(inside)
    state = state.withColumn("first", first)
    # lines before a block's first record belong to the last record of an earlier block
    ends = state.groupBy("file", "block").agg(F.max("first").alias("last"))
    earlier = F.last(F.when(F.col("last").isNotNull(), F.struct(F.col("block").alias("block"), F.col("last").alias("row"))), ignorenulls=True)
    ends = ends.select("file", "block", earlier.over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    owned = state.join(ends, ["file", "block"]).select(
        "file",
        F.coalesce(F.when(F.col("first").isNotNull(), F.struct("block", F.col("first").alias("row"))), F.col("carried")).alias("at"),
        F.struct("block", "row", "value").alias("line"),
        (~F.col("before") & _blank(F.col("value"))).alias("between"),
    )
    text = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["value"]), "\n")
    records = owned.where(~F.col("between")).groupBy("file", "at").agg(text.alias("value"))
    return records.select("file", "at.block", "at.row", "value")


def read_incident_files(
    spark: SparkSession, paths: list[str], with_ordinal: bool = False, skip_unreadable: bool = False, with_file: bool = False
) -> DataFrame:
    """Read CSV incident files, plain or gzipped (all columns as text), aligned by column name.

    Files may differ in header spelling and column set.  A first scan gives each file's header (its first line
    that is not blank) and says whether quoted fields with line breaks may occur; files are split either way.
    Headers are trimmed, lower-cased and given their canonical names, columns that a file lacks are null.
    Quotes inside quoted fields are doubled; a line break within one becomes a line feed; blank lines
    between records are left out, and so is a line that repeats its file's header.

    A file of another format, a damaged one, a quoted field that is never closed and a header with a line
    break are errors; ``skip_unreadable`` leaves whole files of other formats out instead, with a warning
    that names them.  No readable file is an error.
    ``with_ordinal`` adds ``_ordinal`` = (file path, block start, row id within the block) of the record's
    first line, which orders rows as the files list them; ``with_file`` adds ``_file``, the file path.
    """
    other = [p for p in paths if not p.lower().endswith(READABLE)]
    if other and not skip_unreadable:
        raise ValueError(f"only CSV incident files are read: {other}")
    if other:
        log.warning("left out, not CSV: %s", other)
    readable = [p for p in paths if p not in set(other)]
    if not readable:
        raise RuntimeError("No incident data could be read from the given files.")
    lines = _lines(spark, readable)
    files = materialize(_first_lines(lines).where(F.col("header").isNotNull()), "csv-files")
    found = files.groupBy("header").agg(F.max("broken").alias("broken"), F.max(_ends_open(F.col("header"), False)).alias("cut")).limit(MAX_LAYOUTS + 1).collect()
    if not found:
        raise RuntimeError("No incident data could be read from the given files.")
    if len(found) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different header lines")
    if any(r.cut for r in found):
        raise ValueError("a header with a line break in a column name is not read")
    layouts = sorted(r.header for r in found)

    known = checked_broadcast(files)
    met = lines.join(known, "file")
    records = met.where(~F.col("broken") & ~_blank(F.col("value"))).select("file", "block", "row", "value", "header")
    if any(r.broken for r in found):
        torn = _whole_records(lines.join(known.where("broken").select("file"), "file", "left_semi"))
        records = records.unionByName(torn.join(known, "file").select("file", "block", "row", "value", "header"))
    records = records.where(F.col("value") != F.col("header"))

    names = [[n.strip().lower().replace(" ", "_") or f"_c{i}" for i, n in enumerate(next(csv.reader([h])))] for h in layouts]
    width = max(map(len, names))
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)), {"mode": "PERMISSIVE", "escape": '"'})
    parsed = records.select("file", "block", "row", "header", fields.alias("r"))
    wanted = list(dict.fromkeys(RENAMES.get(n, n) for own in names for n in own))
    columns = {}
    for name in wanted:
        value = F.lit(None).cast("string")
        for header, own in zip(layouts, names, strict=True):
            # the canonical spelling before its variants
            at = [i for i, n in enumerate(own) if n == name] + [i for i, n in enumerate(own) if RENAMES.get(n) == name]
            if at:
                value = F.when(F.col("header") == header, F.coalesce(*[F.col(f"r.c{i}") for i in at])).otherwise(value)
        columns[name] = value
    extra = [F.struct("file", "block", "row").alias("_ordinal")] if with_ordinal else []
    extra += [F.col("file").alias("_file")] if with_file else []
    return parsed.select(*[c.alias(k) for k, c in columns.items()], *extra)


# -------------------------------------------------------------------- cache
MANIFEST = "path string, length long, modified long, part string"


def _manifest(spark: SparkSession, cache: str) -> tuple[int, DataFrame | None]:
    """(version, rows) of the newest committed manifest of a cache folder."""
    path, fs = _file_system(spark, f"{cache}/manifest")
    found = []
    if fs.exists(path):
        jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for st in fs.listStatus(path):
            if fs.exists(jvm_path(f"{st.getPath().toString()}/_SUCCESS")):
                found.append(int(st.getPath().getName().split("=")[1]))
    if not found:
        return 0, None
    return max(found), spark.read.schema(MANIFEST).parquet(f"{cache}/manifest/version={max(found)}")


def refresh_cache(spark: SparkSession, files: list[SourceFile], cache: str, skip_unreadable: bool = False) -> list[str]:
    """Bring the cache up to date with ``files`` and return the paths that were read for it.

    The manifest lists every cached file with its length, time and the folder that holds its rows; only files
    that are new or differ are read, into a folder of their own run, one partition a file.  The manifest of a new
    version is written last, so an interrupted refresh leaves the old state; folders that no manifest row names
    any more are deleted after that.  Files that are not among ``files`` keep their rows (other years).
    """
    cache = cache.rstrip("/")
    version, rows = _manifest(spark, cache)
    listed = spark.createDataFrame([(f.path, f.length, f.modified) for f in files], "path string, length long, modified long")
    had = rows if rows is not None else spark.createDataFrame([], MANIFEST)
    stale = [r.path for r in listed.join(had, ["path", "length", "modified"], "left_anti").select("path").toLocalIterator()]
    readable = [p for p in stale if p.lower().endswith(READABLE)]
    if not stale or (skip_unreadable and not readable):
        return []
    part = f"run={uuid.uuid4().hex}"
    raw = read_incident_files(spark, sorted(stale), with_ordinal=True, skip_unreadable=skip_unreadable, with_file=True)
    raw.withColumn("source", F.sha2("_file", 256)).write.partitionBy("source").parquet(f"{cache}/data/{part}")
    fresh = listed.join(spark.createDataFrame([(p,) for p in readable], "path string"), "path", "left_semi").withColumn("part", F.lit(part))
    kept = had.join(fresh.select("path"), "path", "left_anti")
    kept.unionByName(fresh).coalesce(1).write.mode("overwrite").parquet(f"{cache}/manifest/version={version + 1}")
    named = {r.part for r in kept.select("part").distinct().toLocalIterator()} | {part}
    path, fs = _file_system(spark, f"{cache}/data")
    for st in fs.listStatus(path):
        if st.getPath().getName() not in named:
            remove_path(spark, st.getPath().toString())
    for old in range(1, version):
        remove_path(spark, f"{cache}/manifest/version={old}")
    return readable


def cached_raw_incidents(
    spark: SparkSession, root: str, cache: str, years: list[int] | None = None, skip_unreadable: bool = False
) -> DataFrame:
    """Raw rows (with ``_ordinal``) of the files of ``years`` under ``root``, served from ``cache``.

    New and changed files are read into the cache first (:func:`refresh_cache`); rows of files that are gone from
    ``root`` are not served.
    """
    cache = cache.rstrip("/")
    files = list_source_files(spark, root, years)
    refresh_cache(spark, files, cache, skip_unreadable)
    _, rows = _manifest(spark, cache)
    if rows is None:
        raise RuntimeError("No incident data could be read from the given files.")
    listed = spark.createDataFrame([(f.path,) for f in files], "path string")
    wanted = materialize(rows.join(listed, "path", "left_semi").select(F.sha2("path", 256).alias("source"), "part"), "cache-wanted")
    parts = [r.part for r in wanted.select("part").distinct().toLocalIterator()]
    if not parts:
        raise RuntimeError("No incident data could be read from the given files.")
    data = spark.read.option("mergeSchema", True).option("basePath", f"{cache}/data").parquet(*[os.path.join(cache, "data", p) for p in sorted(parts)])
    # both are partition columns: only the wanted files' partitions are read
    own = data.withColumn("part", F.concat(F.lit("run="), F.col("run"))).join(wanted, ["part", "source"], "left_semi")
    return own.drop("part", "run", "source", "_file")
