"""Feed documents to rows. All functions accept batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikeflow import schemas
from bikeflow.functions import documents as docs_fn


def _stations(documents: DataFrame, station: str, outer: bool) -> DataFrame:
    """One row per (document, station). ``data`` may be parsed already or still be text."""
    data = F.col("data")
    if isinstance(documents.schema["data"].dataType, T.StringType):
        data = docs_fn.parse_data(data, station)
    unnest = F.explode_outer if outer else F.explode
    return documents.select("last_updated", data.alias("data")).select(
        "last_updated", unnest("data.stations").alias("station")
    )


def flatten_telemetry(documents: DataFrame, outer: bool = False) -> DataFrame:
    """One row per (document, station, e-bike), with the range estimate opened.

    A station without e-bikes gives no row, unless ``outer``.
    """
    unnest = F.explode_outer if outer else F.explode
    bikes = _stations(documents, schemas.TELEMETRY_STATION, outer).select(
        "last_updated", "station.station_id", unnest("station.ebikes").alias("ebike")
    )
    return bikes.select("last_updated", "station_id", "ebike.*").select(
        "*", "range_estimate.*"
    ).drop("range_estimate")


def flatten_station_information(documents: DataFrame, outer: bool = False) -> DataFrame:
    """One row per (document, station) of the station information feed."""
    rows = _stations(documents, schemas.INFORMATION_STATION, outer)
    return rows.select("last_updated", "station.*")


def flatten_station_status(documents: DataFrame, outer: bool = False) -> DataFrame:
    """One row per (document, station) of the station status feed."""
    rows = _stations(documents, schemas.STATUS_STATION, outer)
    return rows.select("last_updated", "station.*")
