"""Keys and times that every snapshot row gets on its way to the silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikeflow.functions import text, times


def add_snapshot_columns(
    rows: DataFrame, id_name: str | None = None, entity: str | None = None, zone: str | None = None
) -> DataFrame:
    """Add UTC time, local time, numeric epoch and, if asked for, a surrogate key."""
    epoch = times.epoch_seconds(F.col("last_updated").cast("string"))
    columns = []
    if id_name:
        columns.append(text.surrogate_key(F.col(entity), F.col("last_updated")).alias(id_name))
    columns += [
        times.utc_time(epoch).alias("timestamp_utc"),
        times.local_time(epoch, zone).alias("timestamp_local"),
        epoch.alias("last_updated"),
    ]
    rest = [F.col(c) for c in rows.columns if c != "last_updated"]
    return rows.select(*columns, *rest)


def enrich_telemetry(bronze: DataFrame, zone: str | None = None) -> DataFrame:
    """Telemetry silver columns."""
    return add_snapshot_columns(bronze, "ebike_time_id", "rideable_id", zone).select(
        "ebike_time_id",
        "rideable_id",
        "station_id",
        "displayed_number",
        "make_and_model",
        "battery_charge_percentage",
        "conservative_range_miles",
        "estimated_range_miles",
        "timestamp_utc",
        "timestamp_local",
        "last_updated",
    )


def enrich_station_information(bronze: DataFrame, zone: str | None = None) -> DataFrame:
    return add_snapshot_columns(bronze, zone=zone)


def enrich_station_status(bronze: DataFrame, zone: str | None = None) -> DataFrame:
    return add_snapshot_columns(bronze, "station_time_id", "station_id", zone)


def split_rejects(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows with a NULL in the key)."""
    broken = F.lit(False)
    for key in keys:
        broken = broken | F.col(key).isNull()
    return rows.filter(~broken), rows.filter(broken)
