import math

import pytest
from pyspark.sql import functions as F

from bikeflow.functions import geo, text, udfs
from bikeflow.operators import distance, reports, stations as station_ops

TRIPS = "trip_id string, pickup_station_id string, dropoff_station_id string, Rebalancing_trip boolean, maintenance_trip boolean"
STATIONS = "station_id string, name string, lat double, lon double"
PAIR = ["source_station_id", "destination_station_id"]


@pytest.fixture
def stations(spark):
    return spark.createDataFrame([(c, f"n{c}", 42.0 + i / 10, -71.0) for i, c in enumerate("ABCD")], STATIONS)


@pytest.fixture
def trips(spark):
    pairs = [("A", "B"), ("A", "B"), ("B", "A"), ("A", "A"), ("A", "C"), ("C", "D"), ("A", "?"), (None, "A")]
    return spark.createDataFrame([(str(i), p, d, False, False) for i, (p, d) in enumerate(pairs)], TRIPS)


def matrix(spark, rows=()):
    return spark.createDataFrame(list(rows), "source_station_id string, destination_station_id string")


def pairs(df):
    return [tuple(r) for r in df.select(*PAIR).orderBy(*PAIR).collect()]


def test_new_pairs(spark, trips, stations):
    known = matrix(spark, [("A", "B"), (None, "C")])
    assert pairs(distance.new_pairs(trips, stations, known)) == [("A", "C"), ("B", "A"), ("C", "D")]


def test_failing_pairs_keep_no_other_pair_waiting(spark, trips, stations, folder):
    def provider(lat1, lon1, lat2, lon2):
        if lat1 < 42.05:
            raise TimeoutError("never answers")
        return [{"distance": 1000.0, "duration": 10.0}]

    held = matrix(spark)
    for run in range(2):
        rows, failed = distance.extend_matrix(
            trips, stations, held, udfs.route_enricher(provider), answers=f"{folder}/{run}"
        )
        assert pairs(rows) == ([("B", "A"), ("C", "D")] if run == 0 else [])
        assert pairs(failed) == [("A", "B"), ("A", "C")]
        held = held.unionByName(rows.select(*PAIR))
    with pytest.raises(ValueError):
        distance.extend_matrix(trips, stations, held, udfs.route_enricher(provider))


def test_pairs_are_not_gathered_before_the_provider(spark, trips, stations):
    asked = distance.enrich_pairs(distance.new_pairs(trips, stations, matrix(spark)), tasks=8)
    assert "SinglePartition" not in asked._jdf.queryExecution().executedPlan().toString()


def test_programming_errors_of_a_provider_are_raised(spark, trips, stations, folder):
    wrong = udfs.route_enricher(lambda *point: [{"metres": 1}], udfs.Asking(failures=(OSError,)))
    with pytest.raises(Exception, match="KeyError"):
        distance.extend_matrix(trips, stations, matrix(spark), wrong, answers=f"{folder}/answers")


def test_unmatched_rows_with_null_keys_survive_an_anti_join(spark):
    left = spark.createDataFrame([("A", None), ("A", "B")], "a string, b string")
    right = spark.createDataFrame([("A", "B"), ("A", None)], "a string, b string")
    assert [tuple(r) for r in left.join(right, ["a", "b"], "left_anti").collect()] == [("A", None)]


def test_provider_errors_stay_with_their_row(spark, trips, stations, folder):
    def provider(lat1, lon1, lat2, lon2):
        if lat2 > 42.25:
            raise TimeoutError("no answer; try http://x/a;b")
        return [{"distance": 1234.0, "duration": 60.4}, {"distance": 1000.0, "duration": 10.0}]

    rows, failed = distance.extend_matrix(
        trips, stations, matrix(spark), udfs.route_enricher(provider), tasks=2, answers=f"{folder}/answers"
    )
    assert {(r.distance, r.driving_travel_time) for r in rows.collect()} == {(2.2, 70.0)}
    assert [(r.destination_station_id, r.error) for r in failed.collect()] == [
        ("D", "Error: no answer; try http://x/a;b")
    ]


def test_great_circle(spark):
    km = geo.great_circle_km(F.lit(42.0), F.lit(-71.0), F.lit(43.0), F.lit(-71.0))
    assert spark.range(1).select(km).first()[0] == pytest.approx(math.radians(1) * 6371.0)


def test_route_text_split(spark):
    rows = [("1.2;300.0",), ("Error: timeout",), ("Error: a;b;c",), (";5",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(text.route_text_distance(F.col("t")), text.route_text_duration(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        ("1.2", "300.0"), ("", "Error: timeout"), ("Error: a", "b;c"), ("", "5"), (None, None)]


def test_names_stay_for_unknown_stations(spark, trips, stations):
    got = station_ops.with_station_names(trips, stations)
    assert got.count() == 8
    assert {(r.pickup_station_name, r.dropoff_station_name) for r in got.filter("trip_id in ('6', '7')").collect()} == {
        ("nA", None), (None, "nA")}
    assert station_ops.with_station_coordinates(trips, stations).count() == 6


def test_top_routes_counts_ordinary_trips_only(spark, stations):
    rows = [("1", "A", "B", False, False), ("2", "A", "B", True, False), ("3", "B", "A", False, False),
            ("4", "B", "A", False, None), ("5", "X", "Y", False, False), ("6", "Z", "Y", False, False),
            (None, "C", "C", False, False)]
    got = [tuple(r) for r in reports.top_routes(spark.createDataFrame(rows, TRIPS), stations).collect()]
    # Stations without a name fall together, a trip without an id is not counted.
    assert got == [(None, None, 2), ("nA", "nB", 1), ("nB", "nA", 1), ("nC", "nC", 0)]


def test_same_name_of_two_stations_is_one_route(spark):
    stations = spark.createDataFrame([("A", "n", 0.0, 0.0), ("B", "n", 0.0, 0.0)], STATIONS)
    trips = spark.createDataFrame([("1", "A", "A", False, False), ("2", "B", "A", False, False)], TRIPS)
    assert [tuple(r) for r in reports.top_routes(trips, stations).collect()] == [("n", "n", 2)]


def counted(folder, fails, error):
    """A provider that notes each call in a file and fails so often for each pair."""
    import os
    import uuid

    def provider(*point):
        name = "_".join(map(str, point))
        os.makedirs(folder, exist_ok=True)
        before = len([f for f in os.listdir(folder) if f.startswith(name + "@")])
        open(f"{folder}/{name}@{uuid.uuid4().hex}", "w").close()
        if before < fails:
            raise error("not now")
        return [{"distance": 1500.0, "duration": 60.2}]

    return provider


def asked(folder):
    import os
    from collections import Counter

    return Counter(f.split("@")[0] for f in os.listdir(folder))


def points(spark, n):
    return spark.range(n).selectExpr("CAST(id AS DOUBLE) a", "CAST(id AS DOUBLE) b", "1.0D c", "2.0D d").coalesce(1)


def test_a_provider_that_fails_twice_and_then_answers(spark, folder):
    route = udfs.route_enricher(counted(f"{folder}/calls", 2, TimeoutError), udfs.Asking(pause=0.01, workers=4))
    got = points(spark, 30).select(route("a", "b", "c", "d").alias("r")).select("r.*").distinct().collect()
    assert [tuple(r) for r in got] == [(1.5, 60.0, None)]
    assert set(asked(f"{folder}/calls").values()) == {3}


def test_what_may_not_be_retried_is_asked_once(spark, folder):
    route = udfs.route_enricher(counted(f"{folder}/calls", 9, ValueError), udfs.Asking(pause=0.01))
    got = points(spark, 5).select(route("a", "b", "c", "d").alias("r")).select("r.*").distinct().collect()
    assert [tuple(r) for r in got] == [(None, None, "Error: not now")] and set(asked(f"{folder}/calls").values()) == {1}


def test_a_repeated_task_reads_the_answers_it_had(spark, folder):
    """The first attempt dies behind forty pairs; the second asks for the rest only."""
    good = counted(f"{folder}/calls", 0, OSError)

    def dying(*point):
        if point[0] >= 40 and not __import__("os").path.exists(f"{folder}/again"):
            raise KeyError("a mistake in the program")
        return good(*point)

    asking = udfs.Asking(answers=f"{folder}/answers", chunk=10, workers=3)
    rows = points(spark, 60).select(udfs.route_enricher(dying, asking)("a", "b", "c", "d").alias("r")).select("r.*")
    with pytest.raises(Exception, match="a mistake in the program"):
        rows.collect()
    open(f"{folder}/again", "w").close()
    assert [tuple(r) for r in rows.distinct().collect()] == [(1.5, 60.0, None)]
    assert len(asked(f"{folder}/calls")) == 60 and set(asked(f"{folder}/calls").values()) == {1}


def test_equal_pairs_are_asked_once(spark, folder):
    same = spark.range(500).selectExpr("1.0D a", "2.0D b", "3.0D c", "4.0D d").coalesce(1)
    route = udfs.route_enricher(counted(f"{folder}/calls", 0, OSError))
    assert same.select(route("a", "b", "c", "d").alias("r")).select("r.*").distinct().count() == 1
    assert sum(asked(f"{folder}/calls").values()) == 1
