"""Column functions on feed times and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bikeflow import constants as k


def epoch_seconds(text: Column) -> Column:
    """Epoch text of a feed as a number; NULL when the text is not one."""
    return text.try_cast("bigint")


def utc_time(epoch: Column) -> Column:
    return F.timestamp_seconds(epoch)


def local_time(epoch: Column, zone: str | None = None) -> Column:
    """Wall-clock time of the operator.

    The default is the fixed offset of the feed tables, as arithmetic on the epoch: it does
    not go through text and does not depend on the session zone. With ``zone`` the real
    zone rules, including daylight saving, apply.
    """
    if zone is None:
        return F.timestamp_seconds(epoch - F.lit(k.LOCAL_OFFSET_SECONDS))
    return F.from_utc_timestamp(F.timestamp_seconds(epoch), zone)


def local_time_from_text(epoch: Column) -> Column:
    """The same fixed offset through epoch text; needs a session pinned to UTC."""
    return F.to_utc_timestamp(F.from_unixtime(epoch), k.LOCAL_OFFSET_ZONE)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def duration_bucket(seconds: Column) -> Column:
    """Label of the duration class. An unknown duration falls in the open class."""
    chain = F
    for bound, label in k.DURATION_BUCKETS:
        chain = chain.when(seconds < bound, F.lit(label))
    return chain.otherwise(F.lit(k.DURATION_OVERFLOW))


def on_days(ts: str, first: str, last: str) -> Column:
    """Calendar days ``first`` to ``last``, both included.

    Written as a half-open range on the bare column, so that it reaches the file scan.
    """
    start = F.to_timestamp(F.lit(first))
    stop = F.to_timestamp(F.date_add(F.lit(last).cast("date"), 1))
    return (F.col(ts) >= start) & (F.col(ts) < stop)


def capture_stamp(ts: Column) -> Column:
    """Time as it is written in landing file names."""
    return F.date_format(ts, k.CAPTURE_TIME_FORMAT)
