"""Trips out of consecutive readings of the same bike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow import constants as k
from bikeflow import schemas
from bikeflow.functions import text, times
from bikeflow.operators.neighbours import with_neighbours


def next_event(
    events: DataFrame, key: str, ts: str, tie: str, name: str = "next_ts", ranges: int | None = None
) -> DataFrame:
    """Time of the following event of the same key."""
    near = with_neighbours(events, [key], [ts, tie], carry=[ts], after="__next", ranges=ranges)
    return near.withColumn(name, F.col(f"__next.{ts}")).drop("__next")


def consecutive_readings(readings: DataFrame, ranges: int | None = None, also: Sequence[str] = ()) -> DataFrame:
    """Each reading with the next one of its bike in ``end`` (NULL for the last), and more columns of both if asked for.

    Readings must be unique per (rideable_id, last_updated), as the type 1 table keeps them.
    """
    usable = readings.select(*schemas.READING_COLUMNS, *also).filter(
        "rideable_id is not null and last_updated is not null"
    )
    carry = [c for c in usable.columns if c != "rideable_id"]
    return with_neighbours(usable, ["rideable_id"], ["last_updated"], carry, after="end", ranges=ranges)


def moved(start: str = "", end: str = "end.") -> Column:
    """The bike changed station, or stayed and lost range."""
    return (F.col(f"{start}station_id") != F.col(f"{end}station_id")) | (
        F.col(f"{end}estimated_range_miles") < F.col(f"{start}estimated_range_miles")
    )


def trip_columns(pairs: DataFrame, *extra: Column) -> DataFrame:
    """Trip rows from readings paired with the reading that ended the trip (``end``)."""
    seconds = F.col("end.last_updated") - F.col("last_updated")
    battery, end_battery = F.col("battery_charge_percentage"), F.col("end.battery_charge_percentage")
    reach, end_reach = F.col("estimated_range_miles"), F.col("end.estimated_range_miles")
    same_station = F.col("station_id") == F.col("end.station_id")
    topped_up = end_battery.between(battery, battery + k.REBALANCE_BATTERY_GAIN) | end_reach.between(
        reach, reach + k.REBALANCE_RANGE_GAIN
    )
    serviced = (end_battery >= battery + k.MAINTENANCE_BATTERY_GAIN) | (
        end_reach >= reach + k.MAINTENANCE_RANGE_GAIN
    )

    def flag(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    return pairs.select(
        text.surrogate_key(F.col("ebike_time_id"), F.col("end.ebike_time_id")).alias("trip_id"),
        F.col("ebike_time_id").alias("trip_start_id"),
        F.col("end.ebike_time_id").alias("trip_end_id"),
        "rideable_id",
        F.col("timestamp_local").alias("trip_start_time_local"),
        F.col("end.timestamp_local").alias("trip_end_time_local"),
        seconds.alias("trip_duration_seconds"),
        F.col("station_id").alias("pickup_station_id"),
        F.col("end.station_id").alias("dropoff_station_id"),
        times.duration_bucket(seconds).alias("trip_duration_bucket"),
        battery.alias("pickup_battery_charge_percentage"),
        end_battery.alias("dropoff_battery_charge_percentage"),
        reach.alias("pickup_estimated_range_miles"),
        end_reach.alias("dropoff_estimated_range_miles"),
        flag(same_station).alias("Single_station_trip"),
        flag(~same_station & topped_up).alias("Rebalancing_trip"),
        flag(serviced).alias("maintenance_trip"),
        *extra,
    )


def trips_from_pairs(pairs: DataFrame, min_gap: int = k.MIN_TRIP_SECONDS, *extra: Column) -> DataFrame:
    """Keep the pairs that are trips: gap long enough and the bike moved."""
    gap = F.col("end.last_updated") - F.col("last_updated")
    return trip_columns(pairs.filter((gap > min_gap) & moved()), *extra)


def reconstruct_trips(
    readings: DataFrame, min_gap: int = k.MIN_TRIP_SECONDS, ranges: int | None = None
) -> DataFrame:
    """Trips of a whole telemetry table: one shuffle of the readings, no self-join."""
    return trips_from_pairs(consecutive_readings(readings, ranges), min_gap)


def trips_against_stream(readings: DataFrame, arrivals: DataFrame, min_gap: int = k.MIN_TRIP_SECONDS) -> DataFrame:
    """Trips whose end reading is in ``arrivals``, batch or stream; ``readings`` is the static side.

    Each static reading knows only the time of the next one; the arriving reading at that
    time supplies the other end.
    """
    starts = consecutive_readings(readings).withColumn("next_update", F.col("end.last_updated")).drop("end")
    starts = starts.filter(F.col("next_update") - F.col("last_updated") > min_gap)
    ends = arrivals.select(
        F.col("rideable_id").alias("end_bike"),
        F.struct(*[c for c in schemas.READING_COLUMNS if c != "rideable_id"]).alias("end"),
    )
    met = (
        (F.col("rideable_id") == F.col("end_bike"))
        & (F.col("next_update") == F.col("end.last_updated"))
        & moved()
    )
    return trip_columns(starts.join(ends, met, "inner"))
