"""The physical plans are part of the contract: what is shuffled, pruned and pushed down."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bikeflow.operators import reports, scd, sinks, stations as station_ops, trips as trip_ops
from bikeflow.operators.neighbours import SLOT, slotted
from bikeflow.plans import mappings as m

SF = "/root/testdata/sf0.001"
NO_WRITES = [
    "trips", "next_event", "trip_end_readings", "trips_with_station_names", "top_routes_trips", "distinct_pairs",
    "new_station_pairs", "distance_matrix", "scd1_latest", "scd2_history", "scd2_current", "route_counts",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_WRITES)
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_latest_row_filter_runs_before_the_shuffle(spark):
    text = plan(scd.latest_per_key(m.order_changes(spark, SF), ["o_custkey"], "o_orderkey"))
    before, after = text.split("Exchange")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_trips_shuffle_readings_once_by_bike_and_slot(spark, folder):
    m.readings(spark, SF).write.parquet(f"{folder}/r")
    trips = trip_ops.reconstruct_trips(spark.read.parquet(f"{folder}/r"))
    trips.collect()
    text = plan(trips).split("Initial Plan")[0]
    # Only the cuts are joined, a row per range at most; nothing is windowed by the bike alone.
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 1
    windows = [line for line in text.splitlines() if " Window " in line]
    assert len(windows) == 1 and "[rideable_id" in windows[0] and "__slot" in windows[0]
    # The readings cross one shuffle; the other ones carry bike and time, or the cuts.
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(rideable_id" in line and "__slot" in line]
    assert len(wide) == 1
    # Columns that trips do not need are not read.
    assert "make_and_model" not in text


def test_day_range_reaches_the_scan(spark, folder):
    m.published_trips(spark, SF).write.parquet(f"{folder}/h")
    days = reports.with_duration(spark.read.parquet(f"{folder}/h"), "1996-01-01", "1996-12-31")
    pushed = [line for line in plan(days).splitlines() if "PushedFilters" in line]
    assert "GreaterThanOrEqual(started_at" in pushed[0] and "LessThan(started_at" in pushed[0]


def test_open_ranges_are_filtered_in_the_scan(spark, folder):
    ranges = scd.history(m.order_changes(spark, SF), ["o_custkey"], "o_orderkey", ["o_totalprice"])
    ranges.write.parquet(f"{folder}/s")
    text = plan(scd.current_rows(spark.read.parquet(f"{folder}/s")))
    assert "PushedFilters: [IsNull(__END_AT)]" in text


def test_route_report_counts_before_it_joins(spark):
    text = plan(reports.top_routes(m.trips(spark, SF), m.stations(spark, SF)))
    assert text.index("TakeOrderedAndProject") < text.index("Join") < text.rindex("count(trip_id")


def test_hot_key_is_spread_over_tasks(spark):
    """A third of the rows belong to one bike; no task gets them all."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("rideable_id"),
        F.col("id").alias("last_updated"),
    )
    placed = slotted(rows, ["rideable_id"], ["last_updated"], ranges=64).repartition(8, "rideable_id", SLOT)
    sizes = placed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    whole = rows.repartition(8, "rideable_id").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < whole / 2


def test_hot_station_join_is_split_beyond_the_broadcast_size(spark):
    """With a dimension too large to broadcast, the join of a hot station is split at run time."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    trips = spark.range(0, 200_000, 1, 8).select(
        F.col("id").alias("trip_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000).cast("string")).alias("pickup_station_id"),
        (F.col("id") % 4999).cast("string").alias("dropoff_station_id"),
    )
    stations = spark.range(5000).select(F.col("id").cast("string").alias("station_id"), F.col("id").alias("name"))
    stations = stations.unionByName(spark.sql("SELECT 'hot' AS station_id, -1L AS name"))
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        named = station_ops.with_station_names(trips, stations)
        hot = [r.pickup_station_name for r in named.collect() if r.pickup_station_id == "hot"]
        text = plan(named).split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(hot) == 66_667 and set(hot) == {-1}
    assert "SortMergeJoin(skew=true)" in text or "skewed" in text


def test_clustered_write_splits_a_hot_value(spark):
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("t")
    )
    changed = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        sizes = sinks.clustered(rows, ["k", "t"]).groupBy(F.spark_partition_id()).count()
        assert sizes.agg(F.max("count")).first()[0] < 50_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_key_only_rows_have_a_latest_row(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, s bigint")
    assert scd.latest_per_key(rows, ["k", "s"], "s").count() == 2
