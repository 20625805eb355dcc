"""A run that dies between two writes is taken up where it was, with the same result."""

import pytest

from test_scd import COLUMNS, expected_ranges, random_changes, ranges
from test_trips import brute_force, random_readings, short, silver

from bikeflow.operators.neighbours import with_neighbours
from bikeflow.sources.streams import stream_folder
from bikeflow.streaming.ingest import each_batch
from bikeflow.streaming.trips import extend_trips, read_trips
from bikeflow.streaming.upserts import upsert_history
from bikeflow.streaming.partitions import Folder, PartitionedTable, key_bucket


class Crash(Exception):
    pass


class DiesOnce(PartitionedTable):
    """The merge of one batch dies: before its copy counts, behind that, or with half of the partitions in place."""

    dies_at, where = None, "before"

    def _written(self, spark, staged, mark):
        if self._now(staged) and self.where == "before":
            self._die()
        super()._written(spark, staged, mark)

    def _take(self, spark, staged, names):
        if self._now(staged) and self.where != "before":
            if self.where == "half":
                # Spark deletes a partition before it moves the new one there.
                Folder(spark, self.path).delete(f"bucket={names[0]}")
            self._die()
        super()._take(spark, staged, names)

    def _now(self, staged):
        return staged.endswith(f"step={self.dies_at}")

    def _die(self):
        self.dies_at = None
        raise Crash


def dying(path, bucket, cluster_by, where):
    table = DiesOnce(path, bucket, cluster_by)
    table.dies_at, table.where = 1, where
    return table


WHERE = pytest.mark.parametrize("where", ["before", "behind", "half"])


def drain_with_one_crash(spark, folder, schema, step):
    def run():
        each_batch(stream_folder(spark, f"{folder}/in", schema), step, f"{folder}/cp")

    with pytest.raises(Exception, match="Crash"):
        run()
    run()


@WHERE
def test_trips_after_a_crash(spark, folder, where):
    readings = random_readings(200)
    state = dying(f"{folder}/state", key_bucket("rideable_id", buckets=2), ["rideable_id"], where)
    step = extend_trips(state, f"{folder}/trips", f"{folder}/late")
    for i, low in enumerate((0, 2500)):
        part = silver(spark, [r for r in readings if low <= r[1] < low + 2500])
        part.write.mode("append").parquet(f"{folder}/in")
        if i == 0:
            each_batch(stream_folder(spark, f"{folder}/in", part.schema), step, f"{folder}/cp")
        else:
            drain_with_one_crash(spark, folder, part.schema, step)
    assert short(read_trips(spark.read.parquet(f"{folder}/trips"))) == brute_force(readings)


@WHERE
@pytest.mark.parametrize("which", ["log", "out"])
def test_history_after_a_crash(spark, folder, where, which):
    rows = random_changes(80)
    bucket = key_bucket("station_id", buckets=2)
    log, out = (
        (dying(f"{folder}/{n}", bucket, ["station_id"], where) if n == which else PartitionedTable(f"{folder}/{n}", bucket, ["station_id"]))
        for n in ("log", "out")
    )
    step = upsert_history(log, out, ["station_id"], "seq", ["seen"])
    for i in range(2):
        part = spark.createDataFrame(rows[i::2], COLUMNS)
        part.write.mode("append").parquet(f"{folder}/in")
        if i == 0:
            each_batch(stream_folder(spark, f"{folder}/in", part.schema), step, f"{folder}/cp")
        else:
            drain_with_one_crash(spark, folder, part.schema, step)
    assert ranges(out.read(spark)) == expected_ranges(rows)


@pytest.mark.parametrize("cuts", [1, 3, 40])
def test_neighbours_against_brute_force(spark, cuts):
    rows = sorted({(key or "", seq) for key, seq, _, _ in random_changes(150)})
    df = spark.createDataFrame(rows, "k string, s bigint")
    near = with_neighbours(df, ["k"], ["s"], carry=["s"], before="b", after="a", ranges=cuts)
    got = sorted((r.k, r.s, r.b.s if r.b else None, r.a.s if r.a else None) for r in near.collect())
    expected = []
    for i, (key, seq) in enumerate(rows):
        before = rows[i - 1][1] if i and rows[i - 1][0] == key else None
        after = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == key else None
        expected.append((key, seq, before, after))
    assert got == expected
