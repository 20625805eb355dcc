"""Trips while telemetry arrives."""

from __future__ import annotations

import bisect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikeflow import constants as k
from bikeflow import schemas
from bikeflow.operators.enrich import split_rejects
from bikeflow.operators.neighbours import with_neighbours
from bikeflow.operators.scd import latest_per_key
from bikeflow.operators.sinks import CODEC
from bikeflow.operators.trips import consecutive_readings, trips_from_pairs
from bikeflow.streaming.ingest import BatchStep
from bikeflow.streaming.partitions import BUCKET, Folder, PartitionedTable

KEYS = ("rideable_id", "last_updated")

# Readings around some arrived ones: (session, arrived) -> stored rows, the neighbours of each arrived row among them.
LookUp = Callable[[SparkSession, DataFrame], DataFrame]


def whole_table(readings: Callable[[SparkSession], DataFrame]) -> LookUp:
    """Look up the bikes that arrived in all of a table."""

    def look_up(spark: SparkSession, arrived: DataFrame) -> DataFrame:
        bikes = arrived.select("rideable_id").distinct()
        return readings(spark).select(*schemas.READING_COLUMNS).join(bikes, "rideable_id", "left_semi")

    return look_up


def spans_around(table: PartitionedTable, opened: list | None = None) -> LookUp:
    """Look up readings in the partitions of a table by ``time_bucket("last_updated")`` that hold neighbours.

    A neighbour is nearly always in the span of the reading or in one next to it, and these are opened. For readings that
    have none there on a side, the bike's other spans are found from two columns of the rest of the table, and the nearest of
    them are opened as well. ``opened`` collects the names of the partitions read in full.
    """

    def look_up(spark: SparkSession, arrived: DataFrame) -> DataFrame:
        names = table.buckets(spark)
        at = arrived.select("rideable_id", "last_updated").distinct().withColumn("span", table.bucket)
        spans = {r.span for r in at.select("span").distinct().collect()}  # as many as there are partitions at most
        near = {n for span in spans for n in _beside(names, span)}

        # Who lacks a neighbour in its own span and the ones beside it?
        bikes = at.select("rideable_id").distinct()
        times = table.read(spark, near, named=True).select("rideable_id", "last_updated", F.col(BUCKET).alias("span"))
        times = times.join(bikes, "rideable_id", "left_semi").unionByName(at.select("rideable_id", "last_updated", "span")).distinct()
        pairs = with_neighbours(times, ["rideable_id"], ["last_updated"], ["span"], "before", "after")
        beside = _neighbour_spans(spark, names, spans)
        lone = pairs.join(at, ["rideable_id", "last_updated"], "left_semi").join(F.broadcast(beside), "span")
        lone = lone.select(
            "rideable_id", "span",
            (F.col("low").isNotNull() & (F.col("before").isNull() | (F.col("before.span") < F.col("low")))).alias("back"),
            (F.col("high").isNotNull() & (F.col("after").isNull() | (F.col("after.span") > F.col("high")))).alias("on"),
        ).filter("back or on").groupBy("rideable_id", "span").agg(F.max("back").alias("back"), F.max("on").alias("on"))

        # Where else are those bikes? A row per bike and partition at most.
        rest = [n for n in names if n not in near]
        far = set()
        if rest and not lone.isEmpty():
            held = table.read(spark, rest, named=True).select("rideable_id", F.col(BUCKET).alias("span"))
            held = held.join(lone.select("rideable_id").distinct(), "rideable_id", "left_semi").distinct()
            held = held.withColumns({"held": F.col("span"), "back": F.lit(False), "on": F.lit(False)})
            order = Window.partitionBy("rideable_id").orderBy("span")
            rows = held.unionByName(lone.withColumn("held", F.lit(None).cast("string")))
            rows = rows.withColumns({
                "low": F.last("held", True).over(order.rowsBetween(Window.unboundedPreceding, -1)),
                "high": F.first("held", True).over(order.rowsBetween(1, Window.unboundedFollowing)),
            })
            wanted = rows.select(F.explode(F.array(F.when(F.col("back"), F.col("low")), F.when(F.col("on"), F.col("high")))).alias("span"))
            far = {r.span for r in wanted.filter("span is not null").distinct().collect()}
        if opened is not None:
            opened.extend(sorted(near | far))
        return table.read(spark, near | far).select(*schemas.READING_COLUMNS).join(bikes, "rideable_id", "left_semi")

    return look_up


def _beside(names: list[str], span: str) -> list[str]:
    """A partition, if there, and the ones before and behind it."""
    low, high = bisect.bisect_left(names, span), bisect.bisect_right(names, span)
    return names[max(0, low - 1) : high + 1]


def _neighbour_spans(spark: SparkSession, names: list[str], spans: set[str]) -> DataFrame:
    """(span, low, high): the partitions beside each span; null where the table ends there."""
    rows = []
    for span in spans:
        low, high = bisect.bisect_left(names, span), bisect.bisect_right(names, span)
        rows.append((span, names[low - 1] if low else None, names[high] if high < len(names) else None))
    return spark.createDataFrame(rows, "span string, low string, high string")


def settle(arrived: DataFrame, around: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs that begin or end with an arrived reading, pairs that were adjacent before it came between).

    ``around`` holds stored readings, with the neighbours of the arrived ones; the arrived may be among them.
    """
    fresh = latest_per_key(arrived.select(*schemas.READING_COLUMNS), KEYS, "last_updated").withColumn("late", F.lit(True))
    old = around.select(*schemas.READING_COLUMNS).join(fresh, list(KEYS), "left_anti").withColumn("late", F.lit(False))
    pairs = consecutive_readings(old.unionByName(fresh), also=["late"])
    added = pairs.filter(F.col("late") | F.col("end.late"))
    # What an arrived reading is followed by was adjacent to what precedes it.
    broken = added.filter("not late").select("rideable_id", "last_updated").distinct()
    before = consecutive_readings(old, also=["late"]).join(broken, list(KEYS), "left_semi")
    return added, before.filter("end is not null")


def extend_trips(
    state: PartitionedTable,
    trips: str,
    late: str,
    look_up: LookUp | None = None,
    min_gap: int = k.MIN_TRIP_SECONDS,
    rejects: str | None = None,
) -> BatchStep:
    """Step that appends the trips which the readings of a micro-batch complete.

    ``state`` holds the last reading of each bike: a row per bike, however long the history, in partitions of
    which a batch rewrites those of its bikes. The batch is chained behind it by the batch form of trip
    reconstruction, so a bike with most of the rows is spread over tasks here as well. What a batch is compared with lands
    before the state moves on, so a repeated batch compares with the same.

    Readings behind the state are written to ``late``. With ``look_up`` into the telemetry table, which holds
    them by then, trips are set right: those that span a late reading are withdrawn, and those that begin or
    end with one are added. A pair of readings with another between them is never a trip again, so a withdrawal
    holds for good. Readings with a NULL key go to the ``rejects`` folder, if any.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        good, bad = split_rejects(batch.select(*schemas.READING_COLUMNS), KEYS)
        if rejects:
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        placed = _placed(state, good, f"{late}/_placed", batch_id)
        ahead = placed.filter("last is null or last_updated > last.last_updated")
        known = placed.filter("last is not null").select("rideable_id", "last.*").distinct()
        chain = ahead.drop("last").unionByName(known)
        _write_trips(consecutive_readings(chain), f"{trips}/batch={batch_id}/kind=ahead", min_gap)
        moved_on = ahead.drop("last")
        state.merge(moved_on, lambda stored, _: latest_per_key(moved_on.unionByName(stored), ["rideable_id"], "last_updated"), batch_id)

        behind = placed.filter("last_updated < last.last_updated").drop("last")
        if behind.isEmpty():
            return
        behind.write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        if look_up is None:
            return
        arrived = spark.read.schema(behind.schema).parquet(f"{late}/batch={batch_id}")
        _write_settled(*settle(arrived, look_up(spark, arrived)), f"{trips}/batch={batch_id}", min_gap)

    return step


def _placed(state: PartitionedTable, good: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """The readings of a batch, each once, with the last reading of each bike before it (``last``), landed once per batch.

    What the batch is and where it falls is taken from the rows as they came: only landing them shuffles them.
    """
    spark = good.sparkSession
    state.create(spark, good.schema)
    names = sorted(r[0] for r in good.select(state.bucket).distinct().collect())
    rest = [c for c in schemas.READING_COLUMNS if c != "rideable_id"]
    last = state.read(spark, names).select("rideable_id", F.struct(*rest).alias("last"))
    placed = latest_per_key(good, KEYS, "last_updated").join(last, "rideable_id", "left")
    work, mark = Folder(spark, folder), f"batch={batch_id}.done"
    print_of = good.agg(F.count("*"), F.sum(F.xxhash64(*good.columns).cast("decimal(38,0)")).cast("string")).first()
    if work.get(mark) != list(print_of):
        work.delete(mark)
        placed.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        work.put(mark, list(print_of))
    for name in work.names():
        if not name.startswith(f"batch={batch_id}"):
            work.delete(name)
    return spark.read.schema(placed.schema).parquet(f"{folder}/batch={batch_id}")


def join_arrivals(look_up: LookUp, trips: str, min_gap: int = k.MIN_TRIP_SECONDS) -> BatchStep:
    """Step that joins a micro-batch of readings, in any order, to the table that holds them by then.

    Trips that begin or end with an arrived reading are added, those that it falls into are withdrawn: the static side is
    looked up around the arrivals only.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        arrived, _ = split_rejects(batch.select(*schemas.READING_COLUMNS), KEYS)
        added, before = settle(arrived, look_up(batch.sparkSession, arrived))
        _write_settled(added, before, f"{trips}/batch={batch_id}", min_gap)

    return step


def _write_settled(added: DataFrame, before: DataFrame, folder: str, min_gap: int) -> None:
    _write_trips(before, f"{folder}/kind=withdrawn", min_gap)
    _write_trips(added, f"{folder}/kind=late", min_gap)


def _write_trips(pairs: DataFrame, folder: str, min_gap: int) -> None:
    rows = trips_from_pairs(pairs, min_gap)
    rows.sortWithinPartitions("trip_start_time_local", "pickup_station_id").write.mode("overwrite").option("compression", CODEC).parquet(folder)


def read_trips(trips: DataFrame) -> DataFrame:
    """Trips of all micro-batches, each once, without those withdrawn.

    A reading is ahead of its bike's state only once, so those trips are unique as they are.
    A late reading that was delivered before completes the same trip again; late trips are
    few, and only they are compared with the rest.
    """
    gone = trips.filter("kind = 'withdrawn'").select("trip_id")
    return each_once(trips.drop("batch")).join(gone, "trip_id", "left_anti")


def each_once(trips: DataFrame) -> DataFrame:
    """The trips that were added, each once, whether they were withdrawn or not: the rows of ``read_trips`` before that."""
    ahead = trips.filter("kind = 'ahead'").drop("kind")
    late = trips.filter("kind = 'late'").drop("kind").dropDuplicates(["trip_id"])
    again = ahead.select("trip_id").join(late.select("trip_id"), "trip_id", "left_semi")
    return ahead.unionByName(late.join(again, "trip_id", "left_anti"))
