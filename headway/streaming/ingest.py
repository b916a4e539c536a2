"""Append newly landed incident files to the raw Parquet cache, exactly once.

The batch loader reads every yearly file and caches the raw rows; with a file
stream the cache is extended by only the files that arrived since the last
run (the stream's checkpoint remembers which were taken), and a trigger of
``availableNow`` makes each run a bounded batch job.  A landing folder holds
one file layout (a streaming CSV source maps columns by position to the
declared text schema, and a file whose header differs from it stops the stream); rows keep their text values so cleaning stays a batch job.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from headway.operators.clean import normalise_headers, rename_variants
from headway.session import ensure_checkpoint_dir


def ingest_incident_files(
    spark: SparkSession,
    landing_dir: str,
    cache_dir: str,
    header: list[str],
    checkpoint: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Stream CSV files with the given raw header from ``landing_dir`` into ``cache_dir``.

    The stream's checkpoint defaults to ``<spark.checkpoint.dir>/headway-ingest/<cache name>``.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    if checkpoint is None:
        base = ensure_checkpoint_dir(spark)
        if not base:
            raise ValueError("no checkpoint folder: pass checkpoint= or set spark.checkpoint.dir")
        checkpoint = os.path.join(str(base), "headway-ingest", os.path.basename(cache_dir.rstrip("/")))
    stream = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).csv(landing_dir)
    stream = rename_variants(normalise_headers(stream)).withColumn("_source_file", F.col("_metadata.file_path"))
    q = (
        stream.writeStream.format("parquet")
        .option("path", cache_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        q.awaitTermination()
    return q
