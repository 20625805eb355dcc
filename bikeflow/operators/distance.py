"""Incremental station distance matrix."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow.functions.udfs import great_circle_route
from bikeflow.operators.stations import with_station_coordinates


def station_pairs(trips: DataFrame) -> DataFrame:
    """Distinct ordered pairs of different stations that trips connect."""
    return (
        trips.filter("pickup_station_id != dropoff_station_id")
        .select("pickup_station_id", "dropoff_station_id")
        .distinct()
    )


def new_pairs(trips: DataFrame, stations: DataFrame, matrix: DataFrame) -> DataFrame:
    """All pairs with coordinates that the matrix does not hold yet.

    Trips are reduced to pairs before any join.
    """
    placed = with_station_coordinates(station_pairs(trips), stations)
    return placed.select(
        F.col("pickup_station_id").alias("source_station_id"),
        F.col("pickup_station_lat").alias("source_station_lat"),
        F.col("pickup_station_lon").alias("source_station_lon"),
        F.col("dropoff_station_id").alias("destination_station_id"),
        F.col("dropoff_station_lat").alias("destination_station_lat"),
        F.col("dropoff_station_lon").alias("destination_station_lon"),
    ).join(
        matrix.select("source_station_id", "destination_station_id"),
        ["source_station_id", "destination_station_id"],
        "left_anti",
    )


def enrich_pairs(
    pairs: DataFrame, router: Callable[..., Column] = great_circle_route, tasks: int | None = None
) -> DataFrame:
    """Ask ``router`` for each pair. ``tasks`` spreads a slow provider over that many tasks."""
    if tasks:
        pairs = pairs.repartition(tasks, "source_station_id", "destination_station_id")
    route = router(
        F.col("source_station_lat"),
        F.col("source_station_lon"),
        F.col("destination_station_lat"),
        F.col("destination_station_lon"),
    )
    return pairs.withColumn("route", route).select(
        "source_station_id",
        "destination_station_id",
        F.col("route.distance_km").alias("distance"),
        F.col("route.duration_s").alias("driving_travel_time"),
        F.col("route.error").alias("error"),
    )


def extend_matrix(
    trips: DataFrame,
    stations: DataFrame,
    matrix: DataFrame,
    router: Callable[..., Column] = great_circle_route,
    tasks: int | None = None,
    answers: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows to append to the matrix, failed pairs). Failed pairs stay new and are retried.

    Answers of any provider but the built-in arithmetic are written to the ``answers`` folder
    first, so that each pair is asked once however often the two results are used.
    """
    if answers is None and router is not great_circle_route:
        raise ValueError("a provider needs a folder for its answers")
    answered = enrich_pairs(new_pairs(trips, stations, matrix), router, tasks)
    if answers:
        answered.write.mode("overwrite").parquet(answers)
        answered = answered.sparkSession.read.schema(answered.schema).parquet(answers)
    return answered.filter("error is null").drop("error"), answered.filter("error is not null")
