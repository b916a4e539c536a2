"""Where a run's three inputs come from: incidents, hourly weather, forecast weather.

``FixtureInputs`` reads the driver's tables; ``FileInputs`` reads what the
published pipeline consumes: yearly incident CSV files and hourly weather /
forecast documents (parallel arrays under ``hourly``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.clean import clean_incidents
from headway.sources import fixtures as fx
from headway.session import input_bytes
from headway.sources.incidents import cached_raw_incidents, list_incident_files, read_incident_files
from headway.sources.weather_json import explode_hourly, read_hourly_json


@dataclass
class FixtureInputs:
    spark: SparkSession
    sf_dir: str
    ordinal: str = "event_id"
    weather_keys: tuple[str, ...] = ("station", "date", "hour")

    def fact_bytes(self) -> int:
        return input_bytes(self.spark, f"{self.sf_dir.rstrip('/')}/events.parquet")

    def incidents(self) -> DataFrame:
        return fx.incidents_from_events(self.spark, self.sf_dir)

    def weather(self) -> DataFrame:
        return fx.weather_from_orders(self.spark, self.sf_dir)

    def forecast_weather(self) -> DataFrame:
        return fx.forecast_weather_from_orders(self.spark, self.sf_dir)


@dataclass
class FileInputs:
    """Incident CSV files under ``incidents_dir`` for ``years``, weather and forecast JSON documents.

    ``cache_dir``: keep the raw rows there as Parquet; only new and changed files are read again.

    The input order needed for "first" values is (file, block offset, row within
    the block), taken from the scan's file metadata when the files are read.
    """

    spark: SparkSession
    incidents_dir: str
    weather_path: str
    forecast_path: str
    years: tuple[int, ...] = (2024,)
    cache_dir: str | None = None
    skip_unreadable: bool = False
    ordinal: str = "_ordinal"
    weather_keys: tuple[str, ...] = ("date", "hour")

    def fact_bytes(self) -> int:
        return input_bytes(self.spark, *list_incident_files(self.spark, self.incidents_dir, list(self.years)))

    def incidents(self) -> DataFrame:
        years = list(self.years)
        if self.cache_dir:
            return clean_incidents(cached_raw_incidents(self.spark, self.incidents_dir, self.cache_dir, years, self.skip_unreadable))
        files = list_incident_files(self.spark, self.incidents_dir, years)
        return clean_incidents(read_incident_files(self.spark, files, with_ordinal=True, skip_unreadable=self.skip_unreadable))

    def weather(self) -> DataFrame:
        return explode_hourly(read_hourly_json(self.spark, self.weather_path))

    def forecast_weather(self) -> DataFrame:
        return explode_hourly(read_hourly_json(self.spark, self.forecast_path), truncate_date=True)
