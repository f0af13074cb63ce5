"""Station master CSV (UTF-8 with byte-order mark, Korean header)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import STATION_CSV_COLUMNS

_BOM = "\ufeff"


def read_stations(spark: SparkSession, path: str,
                  columns: tuple = STATION_CSV_COLUMNS) -> DataFrame:
    """Read the station master as ``name, lat, lng, end_date``.

    All columns are read as text (no inference pass over the file), the BOM and blanks
    are stripped from the header names, the four configured columns are picked by
    name and cast permissively (bad numbers and dates become null)."""
    raw = (spark.read.option("header", True).option("encoding", "UTF-8")
           .option("inferSchema", False).csv(path))
    clean = {c: c.replace(_BOM, "").strip() for c in raw.columns}
    raw = raw.select([F.col(f"`{c}`").alias(clean[c]) for c in raw.columns])
    name, lat, lng, end = columns
    return raw.select(
        F.trim(F.col(f"`{name}`")).alias("name"),
        F.col(f"`{lat}`").try_cast("double").alias("lat"),
        F.col(f"`{lng}`").try_cast("double").alias("lng"),
        F.coalesce(F.try_to_date(F.col(f"`{end}`")),
                   F.try_to_date(F.col(f"`{end}`"), "yyyyMMdd")).alias("end_date"),
    )


def active_stations(stations: DataFrame) -> DataFrame:
    """Stations without an end date: ``name, lat, lng``."""
    return stations.where(F.col("end_date").isNull()).select("name", "lat", "lng")
