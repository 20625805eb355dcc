import random

import pytest
from pyspark.sql import functions as F

from bikeflow.operators import enrich, scd, trips as ops
from bikeflow.streaming.ingest import each_batch
from bikeflow.streaming.trips import extend_trips, join_arrivals, read_trips, spans_around, whole_table
from bikeflow.streaming.upserts import upsert_latest
from bikeflow.streaming.partitions import PartitionedTable, key_bucket, time_bucket
from bikeflow.sources.streams import stream_folder

BRONZE = (
    "last_updated string, station_id string, battery_charge_percentage bigint, displayed_number string, "
    "make_and_model string, rideable_id string, conservative_range_miles double, estimated_range_miles double"
)


def silver(spark, readings):
    """readings: (bike, second, station, battery, range)."""
    rows = [(str(t), s, b, "n", "m", bike, 0.0, r) for bike, t, s, b, r in readings]
    return enrich.enrich_telemetry(spark.createDataFrame(rows, BRONZE))


def brute_force(readings):
    by_bike = {}
    for bike, t, s, b, r in readings:
        by_bike.setdefault(bike, {})[t] = (s, b, r)
    out = []
    for bike, log in by_bike.items():
        times = sorted(log)
        for t0, t1 in zip(times, times[1:]):
            (s0, _, r0), (s1, _, r1) = log[t0], log[t1]
            if t1 - t0 > 60 and (s0 != s1 or r1 < r0):
                out.append((bike, t1 - t0, s0, s1))
    return sorted(out)


def short(df):
    cols = ["rideable_id", "trip_duration_seconds", "pickup_station_id", "dropoff_station_id"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def random_readings(n=400, seconds=5000):
    rng = random.Random(3)
    seen = {}
    for _ in range(n):
        # One bike has most of the readings.
        bike = "hot" if rng.random() < 0.6 else rng.choice("abc")
        seen[bike, rng.randrange(seconds)] = (rng.choice("ST"), rng.randrange(101), rng.random() * 30)
    return [(bike, t, *rest) for (bike, t), rest in seen.items()]


@pytest.mark.parametrize("gap,kept", [(60, 0), (61, 1)])
def test_gap(spark, gap, kept):
    df = silver(spark, [("a", 0, "S", 50, 9.0), ("a", gap, "T", 50, 9.0)])
    assert ops.reconstruct_trips(df).count() == kept


@pytest.mark.parametrize(
    "gap,label",
    [(599, "0-10 minutes"), (600, "10-30 minutes"), (1799, "10-30 minutes"), (1800, "30-60 minutes"),
     (3599, "30-60 minutes"), (3600, "60+ minutes")],
)
def test_bucket_edges(spark, gap, label):
    df = silver(spark, [("a", 0, "S", 50, 9.0), ("a", gap, "T", 50, 9.0)])
    assert ops.reconstruct_trips(df).first().trip_duration_bucket == label


@pytest.mark.parametrize(
    "battery,reach,station,flags",
    [
        (9, -1.0, "T", (False, True, False)),
        (10, -1.0, "T", (False, False, True)),
        (-5, 3.49, "T", (False, True, False)),
        (-5, 3.495, "T", (False, False, False)),
        (-5, 3.5, "T", (False, False, True)),
        (0, 4.0, "T", (False, True, True)),
        (-5, -1.0, "T", (False, False, False)),
        (5, -1.0, "S", (True, False, False)),
    ],
)
def test_flags(spark, battery, reach, station, flags):
    df = silver(spark, [("a", 0, "S", 50, 8.0), ("a", 100, station, 50 + battery, 8.0 + reach)])
    trip = ops.reconstruct_trips(df).first()
    assert (trip.Single_station_trip, trip.Rebalancing_trip, trip.maintenance_trip) == flags


def test_unknown_values_are_false_flags(spark):
    df = silver(spark, [("a", 0, "S", None, None), ("a", 100, "T", 50, 9.0)])
    trip = ops.reconstruct_trips(df).first()
    assert (trip.Single_station_trip, trip.Rebalancing_trip, trip.maintenance_trip) == (False, False, False)


def test_staying_put_with_no_range_loss_is_no_trip(spark):
    assert ops.reconstruct_trips(silver(spark, [("a", 0, "S", 5, 9.0), ("a", 100, "S", 5, 9.0)])).count() == 0


@pytest.mark.parametrize("cuts", [1, 2, 7, 64])
def test_cuts_do_not_change_the_result(spark, cuts):
    readings = random_readings()
    assert short(ops.reconstruct_trips(silver(spark, readings), ranges=cuts)) == brute_force(readings)


@pytest.mark.parametrize("density", [1, 1_000_000])
def test_one_task_never_gets_a_whole_bike(spark, folder, density):
    """The partitions of the windowed rows themselves, whether readings lie seconds or days apart."""
    rows = [("hot", t * density, "S", 1, 1.0) for t in range(4000)] + [(f"b{t}", t, "S", 1, 1.0) for t in range(2000)]
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        near = ops.consecutive_readings(silver(spark, rows).repartition(6), ranges=40)
        near.withColumn("task", F.spark_partition_id()).write.parquet(f"{folder}/near")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    # Of 6,000 rows a range holds 150; two slots may share a partition.
    sizes = spark.read.parquet(f"{folder}/near").filter("rideable_id = 'hot'").groupBy("task").count().collect()
    assert sum(r["count"] for r in sizes) == 4000 and len(sizes) >= 12
    assert max(r["count"] for r in sizes) <= 4000 / 4


def test_stream_static_form_equals_batch(spark):
    df = silver(spark, random_readings()).cache()
    batch, joined = ops.reconstruct_trips(df), ops.trips_against_stream(df, df)
    assert batch.exceptAll(joined).isEmpty() and joined.exceptAll(batch).isEmpty()


def bike_state(folder):
    return PartitionedTable(f"{folder}/state", key_bucket("rideable_id", buckets=2), ["rideable_id"])


def run_deliveries(spark, folder, deliveries, look_up=None):
    step = extend_trips(bike_state(folder), f"{folder}/trips", f"{folder}/late", look_up)
    for part in deliveries:
        df = silver(spark, part)
        df.write.mode("append").parquet(f"{folder}/in")
        each_batch(stream_folder(spark, f"{folder}/in", df.schema), step, f"{folder}/cp")
    return read_trips(spark.read.parquet(f"{folder}/trips"))


def test_stream_in_order_equals_batch(spark, folder):
    readings = random_readings()
    deliveries = [[r for r in readings if 1000 * i <= r[1] < 1000 * (i + 1)] for i in range(5)]
    # A delivery that brings the last rows again changes nothing.
    got = run_deliveries(spark, folder, [*deliveries, deliveries[-1][:50]])
    assert short(got) == brute_force(readings)


def test_late_reading_goes_to_the_late_folder(spark, folder):
    got = run_deliveries(
        spark, folder,
        [[("a", 0, "S", 5, 9.0), ("a", 1000, "T", 5, 8.0)], [("a", 500, "U", 5, 8.5)], [("a", 2000, "S", 5, 7.0)]],
    )
    assert short(got) == [("a", 1000, "S", "T"), ("a", 1000, "T", "S")]
    assert [r.last_updated for r in spark.read.parquet(f"{folder}/late").collect()] == [500]


def test_late_reading_completes_its_trip_from_the_table(spark, folder):
    def stored(session):
        return silver(session, [("a", 0, "S", 5, 9.0), ("a", 500, "U", 5, 8.5), ("a", 1000, "T", 5, 8.0)])

    got = run_deliveries(
        spark, folder, [[("a", 0, "S", 5, 9.0), ("a", 1000, "T", 5, 8.0)], [("a", 500, "U", 5, 8.5)]], whole_table(stored)
    )
    # The trip that spans the late reading goes, and both its halves come.
    assert short(got) == [("a", 500, "S", "U"), ("a", 500, "U", "T")]


def scattered(readings, n, seed=1):
    shuffled = random.Random(seed).sample(readings, len(readings))
    return [shuffled[i::n] for i in range(n)]


@pytest.mark.parametrize("form", ["late", "arrivals"])
def test_scattered_readings_equal_batch(spark, folder, form):
    """Readings in no order of time, looked up in the partitions around them."""
    readings = random_readings()
    table = PartitionedTable(f"{folder}/telemetry", time_bucket("last_updated", 700), ["rideable_id"])
    store = upsert_latest(table, ["rideable_id", "last_updated"], "last_updated")
    look_up = spans_around(table)
    if form == "late":
        step = extend_trips(bike_state(folder), f"{folder}/trips", f"{folder}/late", look_up)
    else:
        step = join_arrivals(look_up, f"{folder}/trips")
    parts = scattered(readings, 4)
    # The third part comes twice, the second time with new numbers.
    for number, part in enumerate([*parts[:3], parts[2], parts[3]]):
        store(silver(spark, part), number)
        step(silver(spark, part), number)
    assert short(read_trips(spark.read.parquet(f"{folder}/trips"))) == brute_force(readings)


def test_late_readings_open_the_partitions_around_them(spark, folder):
    """Three hundred days of three bikes; a late reading opens its own day, the days beside it, and no more."""
    day = 86_400
    rows = [(b, d * day + 50 * i, "ST"[d % 2], 50, 9.0) for i, b in enumerate("abc") for d in range(300)]
    rows += [("rare", 3 * day, "S", 50, 9.0), ("rare", 290 * day, "T", 50, 8.0)]
    table = PartitionedTable(f"{folder}/telemetry", time_bucket("last_updated", day), ["rideable_id"])
    upsert_latest(table, ["rideable_id", "last_updated"], "last_updated")(silver(spark, rows), 0)
    assert len(table.buckets(spark)) == 300
    for late, most in ((("b", 100 * day + 1000, "U", 50, 8.5), 3), (("rare", 150 * day + 7, "U", 50, 8.5), 5), (("new", 40 * day, "U", 5, 8.5), 3)):
        opened = []
        found = spans_around(table, opened)(spark, silver(spark, [late]))
        assert len(opened) <= most
        mine = sorted(r[1] for r in rows if r[0] == late[0])
        want = {max((t for t in mine if t < late[1]), default=None), min((t for t in mine if t > late[1]), default=None)} - {None}
        assert want <= {r.last_updated for r in found.collect()}


def test_keyless_readings_are_kept_as_rejects(spark, folder):
    step = extend_trips(bike_state(folder), f"{folder}/trips", f"{folder}/late", rejects=f"{folder}/rejects")
    step(silver(spark, [("a", 0, "S", 5, 9.0), (None, 5, "S", 5, 9.0)]), 0)
    assert spark.read.parquet(f"{folder}/rejects").count() == 1


def test_repeated_micro_batch_changes_nothing(spark, folder):
    step = extend_trips(bike_state(folder), f"{folder}/trips", f"{folder}/late")
    first = silver(spark, [("a", 0, "S", 5, 9.0), ("a", 100, "T", 5, 8.0)])
    second = silver(spark, [("a", 300, "S", 5, 7.0)])
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        step(batch, number)
    raw = spark.read.parquet(f"{folder}/trips")
    assert raw.count() == 2 and read_trips(raw).count() == 2


@pytest.mark.parametrize("cuts", [1, 6])
def test_next_event_with_ties(spark, cuts):
    rows = [("u", 0, i) for i in range(5)] + [("u", 90_000, 9), ("v", 1, 7)]
    df = spark.createDataFrame(rows, "user string, s bigint, id int").select("user", F.timestamp_seconds("s").alias("ts"), "id")
    got = {r.id: r.n for r in ops.next_event(df, "user", "ts", "id", ranges=cuts).select("id", F.unix_seconds("next_ts").alias("n")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 90_000, 9: None, 7: None}


def test_duplicates_are_removed_before_trips(spark):
    readings = [("a", 0, "S", 5, 9.0), ("a", 100, "T", 5, 8.0)] * 3
    once = scd.latest_per_key(silver(spark, readings), ["rideable_id", "last_updated"], "last_updated")
    assert ops.reconstruct_trips(once).count() == 1
