import os
import zipfile

import pytest
from pyspark.sql import functions as F

from bikeflow.functions import text
from bikeflow.operators import rider_model, sinks
from bikeflow.sources import archives, files, streams
from bikeflow.streaming.ingest import append_stream

HISTORY = (
    "ride_id string, rideable_type string, started_at timestamp, ended_at timestamp, "
    "start_station_name string, end_station_name string, member_casual string"
)


def test_csv_readers(spark, tmp_path):
    (tmp_path / "sales.csv").write_text("email,n,at\na@x,1,2024-10-28 10:00:00\n,2,2024-10-29 10:00:00\n")
    path = str(tmp_path / "sales.csv")
    assert files.read_csv_text(spark, path).dtypes == [("email", "string"), ("n", "string"), ("at", "string")]
    inferred = files.read_csv(spark, path)
    assert inferred.dtypes == [("email", "string"), ("n", "int"), ("at", "timestamp")]
    assert files.read_csv(spark, path, "email string, n bigint, at timestamp").agg(F.sum("n")).first()[0] == 3
    assert [r.email for r in inferred.orderBy("n").collect()] == ["a@x", None]


def test_zip_archive_from_disk(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "202410.zip", "w") as archive:
        archive.writestr("trips.csv", 'ride_id,n,extra\n"a,1",1,x\n"line\nbreak",2,x\n,bad,x\n')
        archive.writestr("__MACOSX/notes.txt", "not a table")
        archive.writestr("more.csv", "n,ride_id\n7,swapped\n")
        archive.writestr("empty.csv", "ride_id,n\n")
    (tmp_path / "other.bin").write_bytes(b"x")
    rows = archives.zipped_csv_rows(archives.read_archives(spark, str(tmp_path)), "ride_id string, n bigint")
    got = sorted(((r.member, r.ride_id, r.n) for r in rows.collect()), key=repr)
    assert got == [("more.csv", "swapped", 7), ("trips.csv", "a,1", 1), ("trips.csv", "line\nbreak", 2), ("trips.csv", None, None)]
    assert rows.first().archive.endswith("202410.zip")


def test_listing_does_not_read_contents(spark, tmp_path):
    (tmp_path / "a.json").write_text("12345")
    listed = files.list_files(spark, str(tmp_path))
    assert [(r.name, r.size) for r in listed.collect()] == [("a.json", 5)]
    assert "content" not in listed._jdf.queryExecution().optimizedPlan().output().toString()


def test_capture_columns_from_real_files(spark, tmp_path):
    (tmp_path / "ebikes_at_station_20241028100102_77.json").write_text('{"x": 1}')
    row = files.with_capture_columns(spark.read.json(str(tmp_path))).first()
    assert (row.x, row.run_id, row.capture_time.minute) == (1, "77", 1)


def test_path_relations_and_views(spark, tmp_path):
    (tmp_path / "a.txt").write_text("l1\nl2\n")
    frame = files.as_view(files.query_path(spark, "text", str(tmp_path)), "lines_vw")
    assert frame.count() == 2 and spark.sql("SELECT * FROM lines_vw LIMIT 1").count() == 1
    assert files.read_text(spark, str(tmp_path), whole_files=True).count() == 1
    assert sinks.first_rows(frame, 1).count() == 1


def test_create_table_as_fails_on_second_run_unless_overwritten(spark, tmp_path):
    sinks.create_table_as(spark.range(3), "ctas_twice", str(tmp_path / "t"))
    with pytest.raises(Exception):
        sinks.create_table_as(spark.range(3), "ctas_twice", str(tmp_path / "t"))
    sinks.overwrite_table(spark.range(5), "ctas_twice", str(tmp_path / "t"))
    assert files.read_table(spark, "ctas_twice").count() == 5


def test_clustered_files_are_sorted_and_hold_all_rows(spark, tmp_path):
    # One key has most of the rows.
    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), "id")
    sinks.write_clustered(df, str(tmp_path / "c"), ["k"])
    back = spark.read.parquet(str(tmp_path / "c"))
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    for name in os.listdir(tmp_path / "c"):
        if name.endswith(".parquet"):
            keys = [r.k for r in spark.read.parquet(str(tmp_path / "c" / name)).collect()]
            assert keys == sorted(keys)


def test_history_load_keeps_electric_bikes(spark, tmp_path):
    rows = [("1", "electric_bike"), ("2", "classic_bike"), ("3", None)]
    sinks.load_history(spark.createDataFrame(rows, "ride_id string, rideable_type string"), "hist_t", str(tmp_path / "h"))
    assert [r.ride_id for r in spark.table("hist_t").collect()] == ["1"]


def test_stream_takes_each_file_once(spark, tmp_path):
    landing, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    os.mkdir(landing)
    for number in range(3):
        with open(f"{landing}/f{number}.json", "w") as f:
            f.write('{"data": {"stations": []}, "last_updated": %d}\n' % number)
        for _ in range(2):
            append_stream(streams.stream_documents(spark, landing, max_files=1), out, cp)
    got = spark.read.parquet(out)
    assert sorted(r.last_updated for r in got.collect()) == ["0", "1", "2"]
    assert got.first().data == '{"stations": []}' or "stations" in got.first().data


def test_running_stream(spark, tmp_path):
    landing, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    os.mkdir(landing)
    rows = streams.stream_documents(spark, landing)
    query = append_stream(rows, out, cp, cluster_by=["last_updated"], every="1 second")
    try:
        for number in range(2):
            with open(f"{landing}/.f{number}", "w") as f:
                f.write('{"data": {}, "last_updated": %d}\n' % number)
            os.rename(f"{landing}/.f{number}", f"{landing}/f{number}.json")
            query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert sorted(r.last_updated for r in spark.read.parquet(out).collect()) == ["0", "1"]


def test_members_are_dealt_out_and_others_are_listed(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "many.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for k in range(24):
            archive.writestr(f"{k}.csv", "n,t\n" + "".join(f"{k * 100 + i},t{i}\n" for i in range(100)))
        archive.writestr("notes.txt", "not a table")
        archive.writestr("none.csv", "")
    found = archives.read_archives(spark, str(tmp_path))
    assert found.columns == ["path", "length"]
    members = archives.archive_members(found).collect()
    assert sum(r.taken for r in members) == 25 and [r.member for r in members if not r.taken] == ["notes.txt"]
    rows = archives.zipped_csv_rows(found, "n bigint, t string, missing double")
    rows.withColumn("task", F.spark_partition_id()).write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.n for r in back.collect()) == list(range(2400)) and back.filter("missing is not null").isEmpty()
    assert back.select("task").distinct().count() > 8


def test_records_with_breaks_quotes_and_odd_ends(spark, tmp_path):
    text = 'a,b\r\n"x\r\ny","say ""hi"""\r\n\r\n1,"",extra\n"open, no end\n2,'
    with zipfile.ZipFile(tmp_path / "odd.zip", "w") as archive:
        archive.writestr("odd.csv", "\ufeff" + text)
        archive.writestr("short.csv", "b\nonly\n")
    rows = archives.zipped_csv_rows(archives.read_archives(spark, str(tmp_path)), "a string, b string")
    got = {(r.member, r.a, r.b) for r in rows.collect()}
    assert {("odd.csv", "x\r\ny", 'say "hi"'), ("odd.csv", "1", None), ("short.csv", None, "only")} <= got and len(got) == 4


def test_no_archives(spark, tmp_path):
    zipfile.ZipFile(tmp_path / "without-members.zip", "w").close()
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as archive:
        archive.writestr("a.txt", "x")
    assert archives.zipped_csv_rows(archives.read_archives(spark, str(tmp_path)), "a string").collect() == []


def test_rider_model_on_rows_it_has_not_seen(spark):
    """Three hundred stations, of which some are mostly members': far more than a tree has bins."""
    rows = []
    for i in range(6000):
        start = (i * 7919) % 300
        member = (i * 31) % 100 < (90 if start % 3 == 0 else 15)
        rows.append((f"r{i}", "electric_bike", None, None, f"s{start}", f"e{i % 290}", "member" if member else "casual"))
    history = spark.createDataFrame(rows, HISTORY)
    kept = rider_model.held_out("ride_id")
    model = rider_model.fit(history.filter(~kept))
    assert model.stages[-1].getOrDefault("maxBins") == 32
    found = rider_model.evaluate(model, history.filter(kept))
    assert 0.1 < history.filter(kept).count() / 6000 < 0.28
    assert found["accuracy"] > found["majority"] + 0.15 and found["area"] > 0.8


def test_rider_model_with_many_and_missing_stations(spark):
    rows = [
        (str(i), ["electric_bike", "classic_bike"][i % 2], None, None, None if i % 10 == 0 else f"s{i % 50}",
         f"e{i % 45}", "member" if i % 2 else "casual")
        for i in range(400)
    ]
    history = spark.createDataFrame(rows, HISTORY)
    model = rider_model.fit(history, trees=5)
    assert len(model.stages[0].labelsArray[2]) == 45
    unseen = history.withColumn("end_station_name", F.lit("never seen"))
    assert rider_model.predict(model, unseen).count() == 400
    predicted = rider_model.predict(model, history)
    right = predicted.filter("predicted_member_casual = member_casual").count()
    assert right > 350
    assert set(rider_model.overwrite_rider_type(predicted).columns) == set(predicted.columns) - {"predicted_member_casual"}


def test_capture_text_is_null_safe(spark):
    assert tuple(spark.createDataFrame([(None,)], "p string").select(text.capture_time(F.col("p")), text.capture_run(F.col("p"))).first()) == (None, None)


def test_rider_model_evaluates_the_history_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for rows in batches:
            seen.add(len(rows))
            yield rows

    history = spark.range(300).selectExpr(
        "if(id % 2 = 0, 'classic_bike', 'electric_bike') AS rideable_type", "concat('s', id % 9) AS start_station_name",
        "if(id % 5 = 0, null, concat('e', id % 4)) AS end_station_name", "if(id % 3 = 0, 'member', 'casual') AS member_casual",
    )
    model = rider_model.fit(history.mapInPandas(counted, history.schema), trees=3)
    assert seen.value == 300
    assert rider_model.predict(model, history).filter("prediction in (0, 1)").count() == 300
