import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from bikeflow import session
from bikeflow.functions import text, times, udfs
from bikeflow.operators import enrich, reports

EMAILS = [("anna@x.com",), ("",), (None,), ("émile@x",), ("日本",)]
LETTERS = ["a", "", None, "é", "日"]


@pytest.mark.parametrize(
    "form",
    [udfs.first_letter_scalar, udfs.first_letter_decorated, udfs.first_letter_vectorised,
     udfs.first_letter_vectorised_call, udfs.first_letter_iterator, lambda c: text.first_letter(F.col(c))],
)
def test_first_letter_forms(spark, form):
    df = spark.createDataFrame(EMAILS, "email string").coalesce(1)
    assert [r[0] for r in df.select(form("email")).collect()] == LETTERS
    # A batch without any non-empty text.
    only_empty = spark.createDataFrame([("",), ("",)], "email string")
    assert [r[0] for r in only_empty.select(form("email")).collect()] == ["", ""]


def test_registered_form(spark):
    udfs.register(spark)
    spark.createDataFrame(EMAILS, "email string").coalesce(1).createOrReplaceTempView("sales")
    got = spark.sql("SELECT first_letter_of(email) AS firstLetter FROM sales").collect()
    assert [r.firstLetter for r in got] == LETTERS


def test_local_time(spark):
    # Noon UTC in summer and in winter.
    df = spark.createDataFrame([(1720008000,), (1704110400,)], "s bigint")
    got = df.select(
        times.local_time(F.col("s")).alias("fixed"),
        times.local_time_from_text(F.col("s")).alias("by_text"),
        times.local_time(F.col("s"), "America/New_York").alias("zone"),
    ).select(*[F.hour(c) for c in ("fixed", "by_text", "zone")])
    assert [tuple(r) for r in got.collect()] == [(8, 8, 8), (8, 8, 7)]


def test_fixed_offset_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(1704110400,)], "s bigint")
    expected = df.select(F.unix_seconds(times.local_time(F.col("s")))).first()[0]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(F.unix_seconds(times.local_time(F.col("s")))).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_day_range_includes_both_days(spark):
    stamps = ["2024-10-27 23:59:59", "2024-10-28 00:00:00", "2024-10-31 23:59:59", "2024-11-01 00:00:00"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(s),) for s in stamps], "started_at timestamp")
    df = df.withColumn("ended_at", F.col("started_at") + F.expr("interval 600 seconds"))
    got = reports.with_duration(df, "2024-10-28", "2024-10-31").collect()
    assert [r.started_at.day for r in got] == [28, 31]
    assert {r.trip_duration_bucket for r in got} == {"10-30 minutes"}


def test_keys_and_rejects(spark):
    df = spark.createDataFrame([("a", "5"), (None, "5"), ("a", "bad"), ("a", None)], "station_id string, last_updated string")
    good, bad = enrich.split_rejects(enrich.enrich_station_status(df), ["station_id", "last_updated"])
    assert [(r.station_id, r.last_updated) for r in good.collect()] == [("a", 5)] and bad.count() == 3
    assert good.first().station_time_id == hashlib.md5(b"a5").hexdigest()


def test_capture_names(spark):
    names = [
        ("s3://b/landing/ebikes_at_station_20241028100102_77.json",),
        ("/x/station_information_20241028100102.json",),
        ("/x/snapshot=station_status_20240101000000_run-9/part-0.parquet",),
        ("/x/other.json",),
    ]
    df = spark.createDataFrame(names, "p string")
    got = df.select(
        times.capture_stamp(text.capture_time(F.col("p"))).alias("t"), text.capture_run(F.col("p")).alias("r")
    ).collect()
    assert [tuple(r) for r in got] == [
        ("20241028100102", "77"), ("20241028100102", None), ("20240101000000", "run-9"), (None, None)]


def test_schema_name(spark):
    df = spark.createDataFrame([("a.b@c.d",)], "u string")
    assert df.select(text.schema_name(F.col("u"))).first()[0] == "a_b_c_d"


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.work_folder(Session(), "x")
    assert session.on_one_machine("local[4]") and session.on_one_machine("local")
    assert not session.on_one_machine("local-cluster[2,1,1024]") and not session.on_one_machine("yarn")
