"""Slowly changing tables: latest row per key (type 1) and validity ranges (type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikeflow import constants as k
from bikeflow.functions import text
from bikeflow.operators.neighbours import SLOT, SPLIT, in_slots, rank_cuts, slot_window


def latest_per_key(changes: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """One row per key: the one with the highest sequence.

    Equal sequences are settled by a hash of the row, so that reruns agree. The rank filter
    is applied before the shuffle too, so a key with many copies arrives as one row per task.
    """
    rest = [c for c in changes.columns if c not in keys and c != sequence]
    tie = [F.xxhash64(*rest).desc()] + [F.col(c).desc_nulls_last() for c in rest] if rest else []
    newest = [] if sequence in keys else [F.col(sequence).desc_nulls_last()]
    order = Window.partitionBy(*keys).orderBy(*(newest + tie or [F.lit(0)]))
    return changes.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")


def history(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    untracked: Sequence[str] = (),
    unique: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Validity ranges per key: a new range starts when a tracked column changes.

    Columns in ``untracked``, and the sequence itself, do not open a range; they show the
    latest value within it. The open range has a NULL end.
    ``unique`` says that (keys, sequence) is unique already, which saves a shuffle. ``ranges``
    is into how many shares hot keys are cut (see ``neighbours``).

    One window compares each row with its neighbours; a second one, over the first and last rows of
    ranges in the same slots, takes the end of each range to its start, with no further shuffle. A third one, over
    the starts of ranges, links the slots of keys that are split.
    """
    keys = list(keys)
    cuts = rank_cuts(changes, keys, [sequence], ranges)
    log = changes if unique else latest_per_key(changes, [*keys, sequence], sequence)
    loose = [c for c in log.columns if c in untracked or c == sequence]
    tracked = [c for c in log.columns if c not in keys and c not in loose]

    log = log.withColumns({"__state": F.struct(*tracked) if tracked else F.lit(0), "__seq": F.col(sequence)})
    near = in_slots(log, keys, ["__seq"], ["__seq", "__state"], "__prev", "__next", cuts, ranges)
    opens = F.col("__prev").isNull() | ~F.col("__prev.__state").eqNullSafe(F.col("__state"))
    closes = F.col("__next").isNull() | ~F.col("__next.__state").eqNullSafe(F.col("__state"))

    # Only the first and last row of each range matter from here on.
    by_slot = slot_window(keys, ["__seq"])
    final = F.struct(*loose, F.col("__next.__seq").alias("__end"))
    marks = near.withColumns({"__opens": opens, "__closes": closes}).filter("__opens or __closes")
    marks = marks.withColumn("__final", final).drop("__prev", "__next", "__state")
    marks = marks.withColumns({"__mate": F.lead("__final").over(by_slot), "__turn": F.row_number().over(by_slot)})
    whole = F.col("__closes") | F.col("__mate").isNotNull()
    # Of a split key, the first mark of a slot may end a range that began slots before: two rows per slot at most meet.
    edge = F.col(SPLIT) & ((F.col("__turn") == 1) | (F.col("__opens") & ~whole))
    marks = marks.withColumn("__group", F.when(edge, F.lit(-1)).otherwise(F.col(SLOT))).filter((F.col("__group") < 0) | F.col("__opens"))
    over = F.lead("__final").over(Window.partitionBy(*keys, "__group").orderBy("__seq"))
    found = marks.withColumn("__over", over).filter("__opens")
    last = F.when(F.col("__closes"), F.col("__final")).otherwise(F.coalesce("__mate", "__over"))
    found = found.withColumn("__final", last)
    columns: list[Column] = [
        F.col(f"__final.{c}").alias(c) if c in loose else F.col(c) for c in changes.columns
    ]
    return found.select(
        *columns, F.col("__seq").alias(k.START_AT), F.col("__final.__end").alias(k.END_AT)
    )


def current_rows(ranges: DataFrame) -> DataFrame:
    """Rows of the open ranges, without the validity columns."""
    return ranges.filter(F.col(k.END_AT).isNull()).drop(k.START_AT, k.END_AT)


def current_stations(ranges: DataFrame, prefix: str = k.STATION_ID_PREFIX) -> DataFrame:
    """Current station rows under the id form that telemetry uses."""
    return current_rows(ranges).withColumn("station_id", text.prefixed_station_id(F.col("station_id"), prefix))
