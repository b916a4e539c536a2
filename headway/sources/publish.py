"""Publication of a whole run at once.

A run writes its tables and models into a version folder of its own; when everything is there, one small
manifest file is swapped to point to it.  Readers follow the manifest, so they see the old set whole or the new
set whole, also while a run is under way or after one that failed half way.  The swap is a rename over the old
manifest, which is atomic on HDFS and local file systems.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from headway.session import remove_path

CURRENT = "CURRENT.json"
#: Version folders that stay: the current one, and the one that a reader may just be reading.
KEEP = 2


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_version(base: str) -> str:
    """A fresh version folder under ``base`` (nothing is written yet)."""
    return f"{base.rstrip('/')}/versions/{uuid.uuid4().hex}"


def current(spark: SparkSession, base: str) -> dict | None:
    """The manifest of the published version: ``folder``, ``format`` and ``rows`` of each table; None before the first."""
    p, fs = _path(spark, f"{base.rstrip('/')}/{CURRENT}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, base: str, folder: str, rows: dict[str, int], fmt: str = "parquet", keep: int = KEEP) -> dict:
    """Make ``folder`` the published version: its manifest replaces the old one, then superseded versions go.

    A table without a folder there is an error and leaves the old version published.
    """
    base = base.rstrip("/")
    for name in rows:
        p, fs = _path(spark, f"{folder}/{name}")
        if not fs.exists(p):
            raise FileNotFoundError(f"{name} was not written to {folder}")
    had = current(spark, base)
    # newest first; the versions that stay after the swap
    history = [folder, *((had or {}).get("history", []))][:keep]
    manifest = {"folder": folder, "format": fmt, "rows": rows, "history": history}
    target, fs = _path(spark, f"{base}/{CURRENT}")
    draft, _ = _path(spark, f"{base}/.{CURRENT}-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(*[p.makeQualified(fs.getUri(), fs.getWorkingDirectory()) for p in (draft, target)], overwrite)
    versions, vfs = _path(spark, f"{base}/versions")
    stay = {f.rstrip("/").rsplit("/", 1)[-1] for f in history}
    for st in vfs.listStatus(versions):
        if st.getPath().getName() not in stay:
            remove_path(spark, st.getPath().toString())
    return manifest


def read_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of the published version."""
    had = current(spark, base)
    if had is None or name not in had["rows"]:
        raise FileNotFoundError(f"{name} is not published under {base}")
    reader = spark.read.format(had["format"])
    if had["format"] == "csv":
        reader = reader.option("header", True)
    return reader.load(f"{had['folder']}/{name}")
