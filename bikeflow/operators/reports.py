"""Route reports and duration classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikeflow.functions import times


def top_routes(trips: DataFrame, stations: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent routes of ordinary trips: neither rebalancing nor maintenance.

    Trips are counted per station pair first, so the name joins see pairs, not trips. Names
    break ties.
    """
    ordinary = trips.filter("Rebalancing_trip is false and maintenance_trip is false")
    pairs = ordinary.groupBy("pickup_station_id", "dropoff_station_id").agg(F.count("trip_id").alias("trips"))
    names = stations.select("station_id", "name")
    pickup = names.select(F.col("station_id").alias("pickup_station_id"), F.col("name").alias("pickup_station_name"))
    dropoff = names.select(F.col("station_id").alias("dropoff_station_id"), F.col("name").alias("dropoff_station_name"))
    named = pairs.join(pickup, "pickup_station_id", "left").join(dropoff, "dropoff_station_id", "left")
    counts = named.groupBy("pickup_station_name", "dropoff_station_name").agg(F.sum("trips").alias("trip_count"))
    return _top(counts, ["pickup_station_name", "dropoff_station_name"], n)


def route_counts(history: DataFrame) -> DataFrame:
    """Trips per (start, end) station name of the published history."""
    return history.groupBy("start_station_name", "end_station_name").agg(F.count("*").alias("trip_count"))


def top_history_routes(history: DataFrame, n: int = 5) -> DataFrame:
    return _top(route_counts(history), ["start_station_name", "end_station_name"], n)


def _top(counts: DataFrame, names: list[str], n: int) -> DataFrame:
    return counts.orderBy(F.desc("trip_count"), *[F.col(c).asc_nulls_last() for c in names]).limit(n)


def with_duration(history: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Trips started on the given days, with duration and its class."""
    seconds = times.seconds_between(F.col("started_at"), F.col("ended_at"))
    days = history.filter(times.on_days("started_at", first_day, last_day))
    return days.withColumn("trip_duration_seconds", seconds).withColumn(
        "trip_duration_bucket", times.duration_bucket(F.col("trip_duration_seconds"))
    )
