import pathlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from bikeflow.operators import scd
from bikeflow.streaming import partitions
from bikeflow.streaming.upserts import upsert_history, upsert_latest
from bikeflow.streaming.partitions import Folder, MaterializedView, PartitionedTable, key_bucket, own_bucket

COLUMNS = "station_id string, seq bigint, name string, seen string"


def expected_ranges(changes):
    """Brute force: walk each key in sequence order."""
    out, by_key = [], {}
    for key, seq, name, seen in changes:
        by_key.setdefault(key, {})[seq] = (name, seen)
    for key, log in by_key.items():
        runs = []
        for seq in sorted(log):
            name, seen = log[seq]
            if runs and runs[-1]["name"] == name:
                runs[-1].update(seen=seen, last=seq)
            else:
                runs.append({"name": name, "seen": seen, "last": seq, "start": seq})
        for i, run in enumerate(runs):
            end = runs[i + 1]["start"] if i + 1 < len(runs) else None
            out.append((key, run["last"], run["name"], run["seen"], run["start"], end))
    return sorted(out, key=repr)


def ranges(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


CASES = {
    "repeat": [("a", 1, "x", "1"), ("a", 2, "x", "2")],
    "change": [("a", 1, "x", "1"), ("a", 2, "y", "2")],
    "null and back": [("a", 1, "x", "1"), ("a", 2, None, "2"), ("a", 3, None, "3"), ("a", 4, "x", "4")],
    "there and back": [("a", 1, "x", "1"), ("a", 2, "y", "2"), ("a", 3, "x", "3")],
    "late inside a range": [("a", 1, "x", "1"), ("a", 9, "x", "9"), ("a", 5, "y", "5")],
    "two keys": [("a", 1, "x", "1"), ("b", 1, "x", "1"), ("b", 3, "y", "3")],
    "starts with null": [("a", 1, None, "1"), ("a", 2, "x", "2")],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("cuts", [1, 2, 5])
def test_history_cases(spark, case, cuts):
    df = spark.createDataFrame(CASES[case], COLUMNS)
    got = scd.history(df, ["station_id"], "seq", ["seen"], ranges=cuts)
    assert ranges(got) == expected_ranges(CASES[case])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.integers(-20, 40), st.sampled_from(["x", "y", None])),
        min_size=1, max_size=60, unique_by=lambda t: t[:2],
    ),
    st.sampled_from([1, 4, 25]),
)
def test_history_against_brute_force(spark, changes, cuts):
    rows = [(k, s, n, f"{k}{s}") for k, s, n in changes]
    got = ranges(scd.history(spark.createDataFrame(rows, COLUMNS), ["station_id"], "seq", ["seen"], ranges=cuts))
    assert got == expected_ranges(rows)
    for key in {r[0] for r in got}:
        mine = sorted((r for r in got if r[0] == key), key=lambda r: r[4])
        assert sum(r[5] is None for r in mine) == 1
        assert all(a[5] == b[4] for a, b in zip(mine, mine[1:]))


def test_a_range_over_many_slots_ends_where_it_should(spark):
    """One hot key, cut into more slots than it has ranges: starts and ends lie slots apart."""
    rows = [("hot", s, "x" if s < 500 or s > 900 else "y", str(s)) for s in range(1200)] + [("b", 3, None, "3")]
    got = scd.history(spark.createDataFrame(rows, COLUMNS).repartition(5), ["station_id"], "seq", ["seen"], ranges=16)
    assert ranges(got) == expected_ranges(rows)


def test_repeated_changes_and_cuts_at_them(spark):
    rows = [("a", s, "xyz"[s // 7 % 3], str(s)) for s in range(60)]
    df = spark.createDataFrame(rows * 5, COLUMNS).repartition(7)
    assert ranges(scd.history(df, ["station_id"], "seq", ["seen"], ranges=9)) == expected_ranges(rows)


def test_equal_sequences_give_one_row_on_every_run(spark):
    rows = [("a", 1, name, "s") for name in ("x", "y", "z")]
    picks = set()
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        got = scd.latest_per_key(spark.createDataFrame(order, COLUMNS), ["station_id"], "seq").collect()
        assert len(got) == 1
        picks.add(got[0].name)
    assert len(picks) == 1


def test_current_stations_have_the_published_id(spark):
    df = scd.history(spark.createDataFrame(CASES["change"], COLUMNS), ["station_id"], "seq", ["seen"])
    got = scd.current_stations(df)
    assert got.columns == ["station_id", "seq", "name", "seen"]
    assert [tuple(r) for r in got.collect()] == [("motivate_BOS_a", 2, "y", "2")]


def random_changes(n=200):
    rng = random.Random(7)
    rows = {(rng.choice("abcdef"), rng.randrange(60)): rng.choice(["x", "y", None]) for _ in range(n)}
    return [(key, seq, name, f"{key}{seq}") for (key, seq), name in rows.items()]


def test_history_in_shuffled_batches_equals_one_batch(spark, folder):
    rows = random_changes()
    random.Random(1).shuffle(rows)
    bucket = key_bucket("station_id", buckets=3)
    log, out = PartitionedTable(f"{folder}/log", bucket, ["station_id"]), PartitionedTable(f"{folder}/out", bucket, ["station_id"])
    step = upsert_history(log, out, ["station_id"], "seq", ["seen"])
    for i in range(4):
        step(spark.createDataFrame(rows[i::4], COLUMNS), i)
    # The last micro-batch is repeated, as after a crash.
    step(spark.createDataFrame(rows[3::4], COLUMNS), 3)
    assert ranges(out.read(spark)) == expected_ranges(rows)


def test_upsert_keeps_latest_and_sets_null_keys_aside(spark, folder):
    table = PartitionedTable(f"{folder}/t", key_bucket("station_id", buckets=2), ["station_id"])
    step = upsert_latest(table, ["station_id"], "seq", rejects=f"{folder}/rejects")
    step(spark.createDataFrame([("a", 5, "new", ""), ("b", 1, "b1", ""), (None, 1, "?", "")], COLUMNS), 0)
    step(spark.createDataFrame([("a", 2, "late", ""), ("b", 2, "b2", "")], COLUMNS), 1)
    got = {r.station_id: r.name for r in table.read(spark).collect()}
    assert got == {"a": "new", "b": "b2"}
    assert spark.read.parquet(f"{folder}/rejects").count() == 1


def files(folder):
    """Data files below a folder, with when they were written."""
    return {str(f): f.stat().st_mtime_ns for f in pathlib.Path(folder).rglob("*.parquet") if "_staged" not in str(f)}


def test_only_touched_partitions_are_rewritten(spark, folder):
    table = PartitionedTable(f"{folder}/t", key_bucket("station_id", buckets=16), ["station_id"])
    step = upsert_latest(table, ["station_id"], "seq")
    step(spark.createDataFrame([(c, 1, "x", "") for c in "abcdefghijklmnop"], COLUMNS), 0)
    before = files(f"{folder}/t")
    step(spark.createDataFrame([("a", 2, "y", "")], COLUMNS), 1)
    after = files(f"{folder}/t")
    changed = {f.split("bucket=")[1].split("/")[0] for f in set(before.items()) ^ set(after.items()) for f in [f[0]]}
    assert len(changed) == 1 and len({f.split("bucket=")[1].split("/")[0] for f in after}) > 5
    assert table.read(spark).count() == 16


def test_a_batch_of_one_station_reads_and_writes_its_rows_only(spark, folder, monkeypatch):
    log, out = (PartitionedTable(f"{folder}/{n}", own_bucket("station_id"), ["station_id"]) for n in ("log", "out"))
    step = upsert_history(log, out, ["station_id"], "seq", ["seen"])
    rows = random_changes()
    step(spark.createDataFrame(rows, COLUMNS), 0)
    asked, before = [], {n: files(f"{folder}/{n}") for n in ("log", "out")}
    real = PartitionedTable.read
    monkeypatch.setattr(PartitionedTable, "read", lambda t, s, buckets=None, named=False: asked.append(buckets) or real(t, s, buckets, named))
    more = [("c", 1000, "z", "late"), ("c", -5, "early", "early"), ("c", 30, "mid", "mid")]
    step(spark.createDataFrame(more, COLUMNS), 1)
    monkeypatch.undo()
    assert asked and all(len(names) == 1 and names[0].startswith("c-") for names in asked)
    for n in ("log", "out"):
        moved = {f for f, _ in set(before[n].items()) ^ set(files(f"{folder}/{n}").items())}
        assert moved and all("/bucket=c-" in f for f in moved)
    assert ranges(out.read(spark)) == expected_ranges([*(r for r in rows if r[:2] != ("c", 30)), *more])


def test_ranges_of_other_keys_in_a_partition_pass_as_they_are(spark, folder):
    rows = random_changes()
    log, out = (PartitionedTable(f"{folder}/{n}", key_bucket("station_id", buckets=2), ["station_id"]) for n in ("log", "out"))
    step = upsert_history(log, out, ["station_id"], "seq", ["seen"])
    for i in range(5):
        step(spark.createDataFrame(rows[i::5], COLUMNS), i)
    assert ranges(out.read(spark)) == expected_ranges(rows)


def test_an_empty_target_has_its_columns(spark, folder):
    table = PartitionedTable(f"{folder}/t", key_bucket("station_id"), schema=COLUMNS)
    assert table.read(spark).isEmpty() and table.read(spark).columns == ["station_id", "seq", "name", "seen"]
    PartitionedTable(f"{folder}/t", key_bucket("station_id"), schema=COLUMNS).create(spark)
    again = PartitionedTable(f"{folder}/t", key_bucket("station_id"))
    assert again.read(spark).isEmpty() and again.buckets(spark) == []
    assert PartitionedTable(f"{folder}/none", key_bucket("station_id")).read(spark) is None


def test_partitions_that_lose_their_rows_go(spark, folder):
    table = PartitionedTable(f"{folder}/t", F.col("station_id"))
    table.merge(spark.createDataFrame([("a", 1, "x", ""), ("b", 1, "x", "")], COLUMNS), lambda stored, names: spark.createDataFrame([("a", 1, "x", ""), ("b", 1, "x", "")], COLUMNS))
    table.merge(spark.createDataFrame([("a", 2, "x", "")], COLUMNS), lambda stored, names: stored.limit(0))
    assert [r.station_id for r in table.read(spark).collect()] == ["b"] and table.buckets(spark) == ["b"]


def test_other_rows_under_the_number_of_an_old_batch_are_no_repetition(spark, folder):
    """A stream that starts anew counts its batches from 0 again."""
    table = PartitionedTable(f"{folder}/t", key_bucket("station_id", buckets=2))
    step = upsert_latest(table, ["station_id"], "seq")
    step(spark.createDataFrame([("a", 1, "x", "")], COLUMNS), 0)
    step(spark.createDataFrame([("b", 1, "x", "")], COLUMNS), 0)
    step(spark.createDataFrame([("b", 1, "x", "")], COLUMNS), 0)
    assert sorted(r.station_id for r in table.read(spark).collect()) == ["a", "b"]


def test_a_reader_of_a_view_finishes_after_the_switch(spark, folder):
    view = MaterializedView(f"{folder}/v")
    assert view.read(spark) is None
    view.refresh(spark.range(3))
    opened = view.read(spark)
    view.refresh(spark.range(5))
    assert (opened.count(), view.read(spark).count()) == (3, 5)
    # A refresh that died is never current, in this catalog or in another one that finds the folder.
    spark.range(9).write.parquet(f"{folder}/v/refresh=2")
    spark.sql(f"DROP VIEW {view.name}")
    assert MaterializedView(f"{folder}/v").read(spark).count() == 5
    for n in range(4):
        view.refresh(spark.range(n))
    assert view.read(spark).count() == 3 and len(Folder(spark, view.path).names()) <= 8


def test_upserts_tell_a_batch_without_shuffling_it(spark, folder, monkeypatch):
    plans, merge = [], PartitionedTable.merge

    def watched(self, batch, *rest):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        return merge(self, batch, *rest)

    monkeypatch.setattr(PartitionedTable, "merge", watched)
    first = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "b"), (2, 1, "c")], "k int, s int, v string")
    late = spark.createDataFrame([(1, 6, "late"), (2, 2, "d"), (2, 2, "d")], "k int, s int, v string")
    latest = PartitionedTable(f"{folder}/latest", key_bucket("k", buckets=2), ["k"])
    log, ranges = (PartitionedTable(f"{folder}/{n}", key_bucket("k", buckets=2), ["k"]) for n in ("log", "ranges"))
    steps = [upsert_latest(latest, ["k"], "s"), upsert_history(log, ranges, ["k"], "s")]
    for number, batch in enumerate((first, late)):
        for step in steps:
            step(batch, number)
    of_batches = [p for p in plans if "LocalTableScan" in p or "Scan ExistingRDD" in p]
    assert not any("Window" in p for p in of_batches)
    assert sorted(map(tuple, latest.read(spark).collect())) == [(1, 7, "b"), (2, 2, "d")]
    assert sorted(map(tuple, log.read(spark).collect())) == [(1, 5, "a"), (1, 6, "late"), (1, 7, "b"), (2, 1, "c"), (2, 2, "d")]


def test_a_partition_is_gathered_in_shares(spark, folder, monkeypatch):
    monkeypatch.setattr(partitions, "GATHERED_ROWS", 1000)
    table = PartitionedTable(f"{folder}/log", key_bucket("k", buckets=1), ["k"])
    for number in range(2):
        batch = spark.range(number * 4000, number * 4000 + 4000).selectExpr("id % 50 AS k", "id AS s")
        table.merge(batch, lambda stored, _: batch.unionByName(stored), number)
    assert sorted(r.s for r in table.read(spark).collect()) == list(range(8000))
    staged = next(pathlib.Path(folder).glob("log/_staged/step=1/bucket=0"))
    held = [spark.read.parquet(str(p)).count() for p in staged.glob("*.parquet")]
    assert sum(held) == 8000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != partitions.TAKEN_BYTES
    shares = table._shares(spark, ["0"], [["0", 100, ""]])
    assert shares["pieces"] == 9 and shares["tasks"] >= 9
