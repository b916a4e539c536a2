"""Incidents and weather stored by the join's keys, so that the join moves neither.

Weather of many stations is too large to broadcast, and a shuffled join would move the incidents for every
weather delivery.  Stored incidents are bucketed by (join keys, salt) once, when they land; a delivery of
weather is bucketed the same way, and the two meet bucket by bucket without an exchange.

Hot keys: an hour at one station may hold a large share of all incidents.  Keys with more rows than a bucket should
hold get a salt that deals their incidents over several buckets, and the weather rows of those keys, one each
as a rule, are repeated for every salt.  All other keys have salt 0.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.joins import NEUTRAL_WEATHER, WEATHER_COLUMNS
from headway.session import ensure_checkpoint_dir, materialize, remove_path

SALT = "_salt"


@dataclass
class Colocated:
    """Stored incidents: a bucketed table, its keys, and the salts of hot keys (keys, salts)."""

    table: str
    path: str
    keys: tuple[str, ...]
    buckets: int
    hot: DataFrame

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def release(self, spark: SparkSession) -> None:
        spark.sql(f"drop table if exists {self.table}")
        remove_path(spark, self.path)


def _folder(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return os.path.join(str(base), "headway", name)


def _store(df: DataFrame, keys: tuple[str, ...], buckets: int, name: str) -> tuple[str, str]:
    name = f"{name}_{uuid.uuid4().hex}"
    path = _folder(df.sparkSession, name)
    by = [*keys, SALT]
    # one task and one file a bucket, sorted, so that the join needs no sort either
    df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
    return name, path




def store_incidents(incidents: DataFrame, keys: tuple[str, ...], buckets: int, max_rows: int) -> Colocated:
    """Store ``incidents`` bucketed by ``keys`` and a salt; keys with more than ``max_rows`` rows are split.

    Rows with a null key are kept (they meet no weather).  This is the one shuffle of the incidents.
    """
    counts = incidents.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_rows)
    # at most rows / max_rows keys
    hot = materialize(counts.select(*keys, F.ceil(F.col("n") / max_rows).cast("int").alias("salts")), "hot-keys")
    h = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "salts")
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
        cond = c if cond is None else cond & c
    salted = incidents.join(h, cond, "left").withColumn(SALT, F.coalesce(F.pmod(F.xxhash64(*incidents.columns), F.col("salts")).cast("int"), F.lit(0)))
    table, path = _store(salted.drop("salts", *[f"_hot_{k}" for k in keys]), keys, buckets, "incidents_by_key")
    return Colocated(table, path, tuple(keys), buckets, hot)


def join_colocated_weather(stored: Colocated, weather: DataFrame) -> DataFrame:
    """LEFT join of stored incidents to enriched weather, then the neutral fill; equal to ``join_weather``.

    The weather is stored in the incidents' buckets (repeated for the salts of hot keys); the plan reads the
    incidents bucket by bucket, without an exchange.
    """
    spark = weather.sparkSession
    keys = stored.keys
    w = weather.select(*keys, *WEATHER_COLUMNS)
    w = w.join(stored.hot, list(keys), "left")
    salts = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
    w = w.select(*keys, *WEATHER_COLUMNS, F.explode(salts).alias(SALT))
    table, _ = _store(w, keys, stored.buckets, "weather_by_key")
    joined = stored.rows(spark).hint("merge").join(spark.table(table), [*keys, SALT], "left")
    return joined.drop(SALT).na.fill(NEUTRAL_WEATHER)
