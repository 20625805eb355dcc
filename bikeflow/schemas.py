"""Schemas of the feeds and of the tables derived from them."""

from __future__ import annotations

EBIKE = (
    "struct<battery_charge_percentage: bigint, displayed_number: string, docking_capability: bigint, "
    "is_lbs_internal_rideable: boolean, make_and_model: string, "
    "range_estimate: struct<conservative_range_miles: double, estimated_range_miles: double>, "
    "rideable_id: string>"
)
TELEMETRY_STATION = f"struct<ebikes: array<{EBIKE}>, station_id: string>"
INFORMATION_STATION = "struct<station_id: string, name: string, lat: double, lon: double, capacity: bigint>"
STATUS_STATION = (
    "struct<station_id: string, num_bikes_available: bigint, num_docks_available: bigint, "
    "num_ebikes_available: bigint, is_renting: bigint, last_reported: bigint>"
)


def data_type(station: str) -> str:
    """Type of the ``data`` object of a feed, given the type of one station."""
    return f"struct<stations: array<{station}>>"


def document_fields(station: str) -> str:
    """Typed fields of a whole feed document."""
    return f"data {data_type(station)}, last_updated bigint, ttl bigint, version string"


def document_type(station: str) -> str:
    return f"struct<data: {data_type(station)}, last_updated: bigint, ttl: bigint, version: string>"


# Raw reader of every feed: all text, so that one odd document cannot fail a load.
RAW_DOCUMENT = "data string, last_updated string, ttl string, version string"


def parsed_document(station: str) -> str:
    """Raw reader with the ``data`` object typed."""
    return f"data {data_type(station)}, last_updated string, ttl string, version string"


TELEMETRY_BRONZE = (
    "last_updated string, station_id string, battery_charge_percentage bigint, displayed_number string, "
    "docking_capability bigint, is_lbs_internal_rideable boolean, make_and_model string, rideable_id string, "
    "conservative_range_miles double, estimated_range_miles double"
)
INFORMATION_BRONZE = (
    "last_updated string, station_id string, name string, lat double, lon double, capacity bigint"
)
STATUS_BRONZE = (
    "last_updated string, station_id string, num_bikes_available bigint, num_docks_available bigint, "
    "num_ebikes_available bigint, is_renting bigint, last_reported bigint"
)

# Columns of the two key parts and readings that trips need from telemetry.
READING_COLUMNS = (
    "ebike_time_id",
    "rideable_id",
    "station_id",
    "battery_charge_percentage",
    "estimated_range_miles",
    "timestamp_local",
    "last_updated",
)

ROUTE_DOCUMENT = (
    "struct<routes: array<struct<legs: array<struct<steps: "
    "array<struct<distance: double, duration: double>>>>>>>"
)
ROUTE_RESULT = "distance_km double, duration_s double, error string"
DISTANCE_MATRIX = (
    "source_station_id string, destination_station_id string, distance double, driving_travel_time double"
)
