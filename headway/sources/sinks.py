"""Table writers: reporting tables, model metrics, run counters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tables written partitioned (by column) so later readers prune by month.
PARTITION_BY = {"route_daily": ["year_month"]}


# Parquet tables laid out by what the dashboard's slicers choose: files hold ranges of these columns and
# rows lie sorted in them, so that a chosen route or date reads the row groups whose statistics hold it.
CLUSTER_BY = {
    "route_daily": ["route", "date"],
    "route_hourly": ["route", "hour"],
    "tomorrow_forecast": ["date", "route"],
    "network_summary": ["date"],
}


def clustered(df: DataFrame, name: str) -> DataFrame:
    """``df`` dealt by ranges of those slicer columns it has, sorted in each; adaptive execution sizes the files."""
    by = [c for c in [*PARTITION_BY.get(name, []), *CLUSTER_BY.get(name, [])] if c in df.columns]
    return df.repartitionByRange(*by).sortWithinPartitions(*by) if by and name in CLUSTER_BY else df


def write_table(df: DataFrame, out_dir: str, name: str, fmt: str = "parquet") -> str:
    path = os.path.join(out_dir, name)
    if fmt == "parquet":
        df = clustered(df, name)
    w = df.write.mode("overwrite")
    if fmt == "parquet" and name in PARTITION_BY:
        w = w.partitionBy(*PARTITION_BY[name])
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def write_tables(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    return {name: write_table(df, out_dir, name, fmt) for name, df in tables.items()}


def metrics_long(metrics_row: DataFrame) -> DataFrame:
    """One-row metrics frame -> (metric, value) rows."""
    cols = metrics_row.columns
    return metrics_row.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "metric", "value"
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for each produced table, counted by Spark."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
