"""Column functions on ids and delimited text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bikeflow import constants as k


def surrogate_key(*parts: Column) -> Column:
    """MD5 of the joined parts; NULL as soon as one part is NULL."""
    return F.md5(F.concat(*[p.cast("string") for p in parts]))


def first_letter(text: Column) -> Column:
    """Native form of the first-letter functions: '' stays '', NULL stays NULL."""
    return F.substring(text, 1, 1)


def schema_name(user: Column) -> Column:
    """User id as an identifier: '@' and '.' become '_'."""
    return F.translate(user, "@.", "__")


def prefixed_station_id(station_id: Column, prefix: str = k.STATION_ID_PREFIX) -> Column:
    return F.concat(F.lit(prefix), station_id)


def route_text(distance_km: Column, duration_s: Column) -> Column:
    """Route totals in their delimited text form."""
    return F.concat_ws(";", distance_km.cast("string"), duration_s.cast("string"))


def route_text_distance(text: Column) -> Column:
    """Text before the first ';', '' when there is none."""
    return F.when(F.instr(text, ";") > 0, F.substring_index(text, ";", 1)).when(text.isNotNull(), F.lit(""))


def route_text_duration(text: Column) -> Column:
    """Text after the first ';', the whole text when there is none."""
    return F.substr(text, F.instr(text, ";") + 1)


def capture_time(name: Column) -> Column:
    """Capture time in a landing file name, whatever the feed."""
    return F.try_to_timestamp(
        F.regexp_extract(name, r"_(\d{14})(?:_|\.|/|$)", 1), F.lit(k.CAPTURE_TIME_FORMAT)
    )


def capture_run(name: Column) -> Column:
    """Run id in a landing file name; NULL for names without one."""
    return F.nullif(F.regexp_extract(name, r"_\d{14}_([^./_]+)", 1), F.lit(""))
