"""Previous / next row of a key, without ever gathering a whole key in one task.

A plain ``lead`` over the key sends all rows of a hot key to one task. Here the keys and their orders are dealt out by
ranges first, without the other columns, which shows where even shares of all rows end: a few cuts, one per
range, however the values are spread. A key that holds a cut is split there into slots, so a key with a third of
the rows has a third of the cuts; most keys hold none and stay whole. Rows are then windowed per (key, slot) in one
shuffle. The first and last row of a slot are sent to the slot next to theirs as well, as ghosts: every row meets its
neighbours in the window, and the ghosts are dropped behind it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

SLOT, SPLIT = "__slot", "__split"
_GHOST, _AT, _CUTS, _ENDS = "__ghost", "__at", "__cuts", "__ends"


def range_count(spark: SparkSession) -> int:
    """How many partitions a shuffle of the session starts with."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(first or spark.conf.get("spark.sql.shuffle.partitions"))


def _place(order: Sequence[str]) -> Column:
    """The order's columns as one value, under names of its own: only then may values of two tables be compared."""
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def rank_cuts(rows: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The keys that go over the end of a range, with the orders of the first and last rows of ranges in them.

    One row per range and its keys at most, so it may be broadcast whatever the rows are.
    """
    ranges = ranges or range_count(rows.sparkSession)
    key, at = F.struct(*keys), _place(order)
    narrow = rows.select(*keys, *[c for c in order if c not in keys])
    dealt = narrow.repartitionByRange(ranges, *keys, *order).select(key.alias("key"), at.alias("at"))
    place = F.struct("key", "at")
    ends = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    parts = ends.select(F.explode(F.array(F.struct("first.*", F.lit(True).alias("cut")), F.struct("last.*", F.lit(False).alias("cut")))).alias("end"))
    cuts = parts.select("end.*").groupBy("key").agg(
        F.array_sort(F.collect_set(F.when(F.col("cut"), F.col("at")))).alias(_CUTS),
        F.array_sort(F.collect_set(F.when(~F.col("cut"), F.col("at")))).alias(_ENDS),
    )
    return cuts.filter(F.size(_CUTS) > 0).select("key.*", _CUTS, _ENDS)


def _not_above(held: str, at: Column, ranges: int) -> Column:
    """How many entries of a sorted array are not above a value, by halving."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, ranges.bit_length())))])

    def move(place: Column, step: Column) -> Column:
        return F.when(F.get(held, place + step - 1) <= at, place + step).otherwise(place)

    return F.when(F.col(held).isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), move))


def slotted(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: DataFrame | None = None, ranges: int | None = None
) -> DataFrame:
    """Rows with their ``__slot``, whether their key is ``__split``, and the ghosts that stand in slots next to theirs.

    ``cuts`` may come from any rows with the same keys and orders, such as the same rows before others were dropped,
    as long as each of its ends is still among the rows.
    """
    ranges = ranges or range_count(rows.sparkSession)
    cuts = rank_cuts(rows, keys, order, ranges) if cuts is None else cuts
    cuts = cuts.select(*[F.col(c).alias(f"__cut_{i}") for i, c in enumerate(keys)], _CUTS, _ENDS)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"__cut_{i}")) for i, c in enumerate(keys)))
    at = _place(order)
    found = rows.join(F.broadcast(cuts), same, "left").drop(*[f"__cut_{i}" for i in range(len(keys))])
    found = found.withColumn(SLOT, _not_above(_CUTS, at, ranges))
    first = F.get(_CUTS, F.col(SLOT) - 1) == at
    last = F.get(_ENDS, _not_above(_ENDS, at, ranges) - 1) == at
    # Where a key is not split, the row itself is all there is.
    here = F.struct(F.col(SLOT).alias("slot"), F.lit(False).alias("ghost"))
    back = F.when(first, F.struct((F.col(SLOT) - 1).alias("slot"), F.lit(True).alias("ghost")))
    on = F.when(last, F.struct((F.col(SLOT) + 1).alias("slot"), F.lit(True).alias("ghost")))
    places = F.when(F.col(_CUTS).isNull(), F.array(here)).otherwise(F.array_compact(F.array(here, back, on)))
    found = found.withColumns({SPLIT: F.col(_CUTS).isNotNull(), _AT: F.explode(places)})
    return found.withColumns({SLOT: F.col(f"{_AT}.slot"), _GHOST: F.col(f"{_AT}.ghost")}).drop(_AT, _CUTS, _ENDS)


def slot_window(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, SLOT).orderBy(*order)


def in_slots(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    before: str | None = None,
    after: str | None = None,
    cuts: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """As ``with_neighbours``, with ``__slot`` and ``__split``: what follows can be windowed by slot without a shuffle."""
    window, payload, added = slot_window(keys, order), F.struct(*carry), {}
    if before:
        added[before] = F.lag(payload).over(window)
    if after:
        added[after] = F.lead(payload).over(window)
    return slotted(rows, keys, order, cuts, ranges).withColumns(added).filter(~F.col(_GHOST)).drop(_GHOST)


def with_neighbours(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    before: str | None = None,
    after: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add struct columns ``before`` / ``after`` holding ``carry`` of the adjacent rows of the key.

    The order must be unique within the key for a stable result. ``ranges`` is into how many even shares
    the rows are cut, by default the partitions of a shuffle; it does not change the result.
    """
    return in_slots(rows, keys, order, carry, before, after, ranges=ranges).drop(SLOT, SPLIT)
