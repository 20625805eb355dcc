"""Joins of trips with the station dimension.

No join carries a broadcast hint: Spark broadcasts the dimension while its measured size is
under the session threshold, and beyond it uses a sort-merge join whose hot stations
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikeflow import constants as k


def _role(stations: DataFrame, role: str, columns: dict[str, str]) -> DataFrame:
    return stations.select(
        F.col("station_id").alias(f"{role}_station_id"),
        *[F.col(source).alias(name) for source, name in columns.items()],
    )


def with_station_names(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Every trip, with the current names of both its stations (NULL when unknown)."""
    out = trips
    for role in ("pickup", "dropoff"):
        names = _role(stations, role, {"name": f"{role}_station_name"})
        out = out.join(names, f"{role}_station_id", "left")
    return out.select(*trips.columns, "pickup_station_name", "dropoff_station_name")


def with_names_from_history(trips: DataFrame, ranges: DataFrame, prefix: str = k.STATION_ID_PREFIX) -> DataFrame:
    """The same, straight from the type 2 table: its open ranges are the current rows."""
    open_rows = ranges.filter(F.col(k.END_AT).isNull())
    ids = open_rows.withColumn("station_id", F.concat(F.lit(prefix), F.col("station_id")))
    return with_station_names(trips, ids)


def with_station_coordinates(pairs: DataFrame, stations: DataFrame) -> DataFrame:
    """Rows whose two stations are both known, with their coordinates."""
    out = pairs
    for role in ("pickup", "dropoff"):
        spot = _role(stations, role, {"lat": f"{role}_station_lat", "lon": f"{role}_station_lon"})
        out = out.join(spot, f"{role}_station_id", "inner")
    added = [f"{role}_station_{axis}" for role in ("pickup", "dropoff") for axis in ("lat", "lon")]
    return out.select(*pairs.columns, *added)
