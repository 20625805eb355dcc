import json

import pytest

from pyspark.sql import functions as F

from bikeflow.plans.medallion import Medallion
from bikeflow.sources.streams import stream_folder
from bikeflow.streaming.ingest import each_batch, merge_batches, read_batches
from bikeflow.streaming.partitions import Folder


def land(folder, feed, name, stations, at):
    path = folder / feed
    path.mkdir(parents=True, exist_ok=True)
    body = {"data": {"stations": stations}, "last_updated": at, "ttl": 60, "version": "1.1"}
    (path / f"{name}.json").write_text(json.dumps(body))


def telemetry(bikes):
    """bikes: {station: [(bike, battery, range)]}"""
    return [
        {"station_id": f"motivate_BOS_{s}", "ebikes": [
            {"rideable_id": b, "battery_charge_percentage": c,
             "range_estimate": {"conservative_range_miles": r / 2, "estimated_range_miles": r}} for b, c, r in rows]}
        for s, rows in bikes.items()
    ]


def information(names):
    return [{"station_id": s, "name": n, "lat": 42.0, "lon": -71.0, "capacity": 10} for s, n in names.items()]


@pytest.fixture
def tables(spark, tmp_path):
    return Medallion(spark, str(tmp_path / "landing"), str(tmp_path / "warehouse"), history_buckets=2)


def named(df):
    cols = ["rideable_id", "trip_duration_seconds", "pickup_station_name", "dropoff_station_name"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_incremental_runs(spark, tmp_path, tables):
    landing = tmp_path / "landing"
    land(landing, "station_information", "station_information_1", information({"1": "One", "2": "Two"}), 1000)
    land(landing, "station_status", "station_status_1",
         [{"station_id": "1", "num_bikes_available": 3, "num_docks_available": 7}], 1000)
    land(landing, "ebikes_at_station", "e_1", telemetry({"1": [("a", 50, 9.0), ("b", 50, 9.0)], "2": []}), 1000)
    land(landing, "ebikes_at_station", "e_2", telemetry({"1": [("b", 50, 9.0)], "2": [("a", 40, 8.0)]}), 1100)
    assert named(tables.run()) == [("a", 100, "One", "Two")]

    # Nothing new: nothing changes.
    before = tables.station_history.read(spark).count()
    assert named(tables.run()) == [("a", 100, "One", "Two")]
    assert tables.station_history.read(spark).count() == before == 2

    # The same snapshot again under another name, a renamed station, a new trip, a new status.
    land(landing, "ebikes_at_station", "e_2_again", telemetry({"1": [("b", 50, 9.0)], "2": [("a", 40, 8.0)]}), 1100)
    land(landing, "ebikes_at_station", "e_3", telemetry({"1": [("a", 30, 7.0), ("b", 50, 9.0)]}), 2000)
    land(landing, "station_information", "station_information_2", information({"1": "Uno", "2": "Two"}), 1500)
    land(landing, "station_status", "station_status_2", [{"station_id": "1", "num_bikes_available": 4}], 2000)
    assert named(tables.run()) == [("a", 100, "Uno", "Two"), ("a", 900, "Two", "Uno")]
    assert tables.telemetry.read(spark).count() == 6
    assert tables.status.read(spark).count() == 2
    history = sorted((r.station_id, r.name, r["__START_AT"], r["__END_AT"]) for r in tables.station_history.read(spark).collect())
    assert history == [("1", "One", 1000, 1500), ("1", "Uno", 1500, None), ("2", "Two", 1000, None)]
    current = {r.station_id: (r.name, r.last_updated) for r in tables.current_stations.read(spark).collect()}
    assert current == {"motivate_BOS_1": ("Uno", 1500), "motivate_BOS_2": ("Two", 1500)}

    # The distance matrix is complete after the run, and asking again adds nothing.
    assert tables.matrix.read(spark).count() == 2
    assert tables.extend_matrix().isEmpty()
    assert tables.matrix.read(spark).count() == 2
    tables.register_views()
    assert spark.sql("SELECT count(*) FROM trips JOIN stations ON pickup_station_id = station_id").first()[0] == 2
    tables.tidy()
    assert tables.matrix.read(spark).count() == 2 and tables.telemetry.read(spark).count() == 6


def test_late_snapshot(spark, tmp_path, tables):
    landing = tmp_path / "landing"
    land(landing, "station_information", "i", information({"1": "One", "2": "Two", "3": "Three"}), 1000)
    land(landing, "station_status", "s", [{"station_id": "1"}], 1000)
    land(landing, "ebikes_at_station", "e_1", telemetry({"1": [("a", 50, 9.0)]}), 1000)
    land(landing, "ebikes_at_station", "e_3", telemetry({"2": [("a", 50, 8.0)]}), 3000)
    tables.run()
    land(landing, "ebikes_at_station", "e_2", telemetry({"3": [("a", 50, 8.5)]}), 2000)
    assert named(tables.run()) == [("a", 1000, "One", "Three"), ("a", 1000, "Three", "Two")]
    assert spark.read.parquet(str(tmp_path / "warehouse/gold/late_readings")).count() == 1


def test_bad_documents_do_not_stop_the_run(spark, tmp_path, tables):
    landing = tmp_path / "landing"
    land(landing, "station_information", "i", information({"1": "One", "2": "Two"}), 1000)
    land(landing, "station_status", "s", [{"station_id": "1"}], 1000)
    land(landing, "ebikes_at_station", "e_1", telemetry({"1": [("a", 50, 9.0)]}), 1000)
    land(landing, "ebikes_at_station", "e_2", telemetry({"2": [("a", 50, 8.0)]}), 1100)
    land(landing, "ebikes_at_station", "e_4", telemetry({"2": [("a", 50, 8.0)]}), "soon")
    (landing / "ebikes_at_station" / "e_3.json").write_text("{broken")
    assert named(tables.run()) == [("a", 100, "One", "Two")]
    rejects = spark.read.parquet(str(tmp_path / "warehouse/silver/telemetry_rejects"))
    assert rejects.count() == 1
    broken = spark.read.parquet(str(tmp_path / "warehouse/bronze/ebikes_at_station_rejects"))
    assert [r.document for r in broken.collect()] == ["{broken"]


def day_files(tmp_path):
    folder = tmp_path / "warehouse/gold/trips_with_names"
    found = {}
    for f in folder.glob("bucket=*/*.parquet"):
        found.setdefault(f.parent.name.removeprefix("bucket="), set()).add((f.name, f.stat().st_mtime_ns))
    return found


def test_only_days_with_changes_are_named_anew(spark, tmp_path, tables):
    day, landing = 86_400, tmp_path / "landing"
    land(landing, "station_information", "i1", information({"1": "One", "2": "Two", "3": "Three", "4": "Four"}), 1000)
    land(landing, "station_status", "s", [{"station_id": "1"}], 1000)
    # Day 0 and 1 between stations 1 and 2, day 2 between 3 and 4.
    for n, (at, place) in enumerate([(50_000, "1"), (51_000, "2"), (50_000 + day, "1"), (50_000 + 2 * day, "3"), (51_000 + 2 * day, "4")]):
        bike = "a" if place in "12" else "b"
        land(landing, "ebikes_at_station", f"e_{n}", telemetry({place: [(bike, 50, 9.0 - n)]}), at)
    assert len(named(tables.run())) == 3
    first = day_files(tmp_path)
    assert sorted(first) == ["1970-01-01", "1970-01-03"]

    # Nothing new: no file is touched. A renamed station: only the days of its trips.
    tables.run()
    assert day_files(tmp_path) == first
    land(landing, "station_information", "i2", information({"1": "One", "2": "Two", "3": "Drei", "4": "Four"}), 2000)
    assert ("b", 1000, "Drei", "Four") in named(tables.run())
    second = day_files(tmp_path)
    assert second["1970-01-01"] == first["1970-01-01"] and second["1970-01-03"] != first["1970-01-03"]

    # A late reading withdraws one trip and brings two; the day of the other trips stays.
    land(landing, "ebikes_at_station", "late", telemetry({"4": [("a", 50, 8.9)]}), 50_500)
    got = named(tables.run())
    assert ("a", 1000, "One", "Two") not in got and ("a", 500, "One", "Four") in got and ("a", 500, "Four", "Two") in got
    assert day_files(tmp_path)["1970-01-03"] == second["1970-01-03"]
    assert named(tables.trips().selectExpr("*", "pickup_station_id pickup_station_name", "dropoff_station_id dropoff_station_name")) == sorted(
        (b, s, {"One": "motivate_BOS_1", "Two": "motivate_BOS_2", "Drei": "motivate_BOS_3", "Four": "motivate_BOS_4"}[p],
         {"One": "motivate_BOS_1", "Two": "motivate_BOS_2", "Drei": "motivate_BOS_3", "Four": "motivate_BOS_4"}[d]) for b, s, p, d in got)


def test_landing_files_move_to_the_archive(spark, tmp_path):
    tables = Medallion(spark, str(tmp_path / "landing"), str(tmp_path / "warehouse"), archive=str(tmp_path / "archive"))
    landing = tmp_path / "landing"
    for n in range(3):
        land(landing, "ebikes_at_station", f"e_{n}", telemetry({"1": [("a", 50, 9.0)]}), 1000 + n)
        tables.ingest_feed("ebikes_at_station")
    # Spark moves the files of a batch away when it has begun the next one.
    land(landing, "ebikes_at_station", "e_9", telemetry({"1": [("a", 50, 9.0)]}), 2000)
    tables.ingest_feed("ebikes_at_station")
    assert len(list((landing / "ebikes_at_station").glob("*.json"))) < 4
    assert list((tmp_path / "archive").rglob("*.json"))
    assert tables.bronze("ebikes_at_station").count() == 4


def test_fifty_batches_are_few_folders(spark, tmp_path):
    target, landed = str(tmp_path / "bronze"), str(tmp_path / "in")
    rows, seen = [], []

    def take(batch, number):
        seen.extend(r.id for r in batch.collect())

    for n in range(50):
        part = spark.range(n * 10, n * 10 + 10).withColumn("kind", F.lit("ab"[n % 2]))
        part.coalesce(1).write.partitionBy("kind").parquet(f"{target}/batch={n}")
        rows += range(n * 10, n * 10 + 10)
        if n % 7 == 6:
            each_batch(stream_folder(spark, target, "id bigint"), take, f"{landed}/cp")
            merge_batches(spark, target, 4, ["kind"])
            assert sorted(r.id for r in read_batches(spark, target).collect()) == rows
    each_batch(stream_folder(spark, target, "id bigint"), take, f"{landed}/cp")
    assert sorted(seen) == rows
    merge_batches(spark, target, 0, ["kind"])
    assert sorted((r.id, r.kind) for r in read_batches(spark, target).collect()) == [(i, "ab"[i // 10 % 2]) for i in rows]
    assert len(list((tmp_path / "bronze").glob("batch=*"))) == 0 and len(list((tmp_path / "bronze_merged").glob("*.done"))) <= 6


def test_a_merge_that_died_counts_no_row_twice(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    for n in range(6):
        spark.range(n, n + 1).write.parquet(f"{target}/batch={n}")
    real = Folder.delete
    monkeypatch.setattr(Folder, "delete", lambda self, name: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        merge_batches(spark, target, 2)
    monkeypatch.setattr(Folder, "delete", real)
    assert sorted(r.id for r in read_batches(spark, target).collect()) == list(range(6))
    merge_batches(spark, target, 2)
    assert sorted(r.id for r in read_batches(spark, target).collect()) == list(range(6))
