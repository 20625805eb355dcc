"""The registered queries: each operator on the given tables.

Each takes (spark, folder of the tables) and returns a DataFrame with plain timestamps.
"""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikeflow import constants as k
from bikeflow import schemas
from bikeflow.functions import documents, text, times, udfs
from bikeflow.operators import (
    distance,
    enrich,
    flatten,
    reports,
    rider_model,
    scd,
    sinks,
    stations as station_ops,
    trips as trip_ops,
)
from bikeflow.operators.neighbours import with_neighbours
from bikeflow.plans import mappings as m
from bikeflow.plans.medallion import Medallion
from bikeflow.session import pin_utc, work_folder
from bikeflow.sources import archives, files, streams
from bikeflow.sources.places import open_place
from bikeflow.streaming.ingest import append_stream, each_batch
from bikeflow.streaming.trips import extend_trips, join_arrivals, read_trips, spans_around
from bikeflow.streaming.upserts import upsert_history, upsert_latest
from bikeflow.streaming.partitions import MaterializedView, PartitionedTable, key_bucket, time_bucket

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Landing files that Spark writes for these queries.
PART_FILES = "part-*"
WEEK = 7 * 86_400


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return m.plain_times(fn(pin_utc(spark), sf))

    QUERIES[fn.__name__] = run
    return run


# -- trips and windows -------------------------------------------------------------------


@query
def trips(spark, sf):
    return m.trips(spark, sf)


@query
def next_event(spark, sf):
    events = m.table(spark, sf, "events").select("event_id", "user_id", "ts")
    return trip_ops.next_event(events, "user_id", "ts", "event_id")


@query
def trip_end_readings(spark, sf):
    """Readings joined to the bike's next reading time: two keys, one of them computed."""
    readings = m.readings(spark, sf)
    coming = trip_ops.consecutive_readings(readings).select(
        "rideable_id", "last_updated", F.col("end.last_updated").alias("next_updated")
    )
    ends = readings.select(
        "rideable_id", F.col("last_updated").alias("next_updated"), F.col("station_id").alias("next_station_id")
    )
    return coming.join(ends, ["rideable_id", "next_updated"])


@query
def trips_with_station_names(spark, sf):
    return station_ops.with_station_names(m.trips(spark, sf), m.stations(spark, sf))


@query
def trips_with_names_from_history(spark, sf):
    """Names straight from the type 2 table: the validity test is part of the join."""
    landed = _landed(spark, "nations", m.nation_documents(m.table(spark, sf, "nation")))
    rows = flatten.flatten_station_information(files.read_json(spark, landed, schemas.RAW_DOCUMENT))
    ranges = scd.history(
        enrich.enrich_station_information(rows),
        ["station_id"],
        "last_updated",
        ["timestamp_utc", "timestamp_local"],
    )
    return station_ops.with_names_from_history(m.trips(spark, sf), ranges)


@query
def trips_with_coordinates(spark, sf):
    placed = station_ops.with_station_coordinates(m.trips(spark, sf), m.stations(spark, sf))
    added = [c for c in placed.columns if c.endswith(("_lat", "_lon"))]
    return placed.select("trip_id", "pickup_station_id", "dropoff_station_id", *added)


@query
def top_routes_trips(spark, sf):
    return reports.top_routes(m.trips(spark, sf), m.stations(spark, sf))


@query
def distinct_pairs(spark, sf):
    return distance.station_pairs(m.trips(spark, sf))


def _travelled(spark: SparkSession, sf: str) -> DataFrame:
    """The stations of all trips, landed: pairs are counted against what the matrix holds of them, so they are read twice."""
    folder = work_folder(spark, "travelled")
    m.trips(spark, sf).select("pickup_station_id", "dropoff_station_id").write.parquet(folder)
    return spark.read.parquet(folder)


@query
def new_station_pairs(spark, sf):
    trip_rows = _travelled(spark, sf)
    return distance.new_pairs(trip_rows, m.stations(spark, sf), m.known_pairs(trip_rows))


@query
def distance_matrix(spark, sf):
    trip_rows = _travelled(spark, sf)
    added, _ = distance.extend_matrix(trip_rows, m.stations(spark, sf), m.known_pairs(trip_rows))
    return added


def sample_route(lat1: float, lon1: float, lat2: float, lon2: float) -> list[dict]:
    """A provider without a network: north-south leg, then east-west leg."""
    if lon1 == lon2:
        raise ValueError("no road")
    north, east = abs(lat2 - lat1) * 100_000, abs(lon2 - lon1) * 80_000
    return [{"distance": north, "duration": north / 4}, {"distance": east, "duration": east / 4}]


@query
def route_enrichment_udf(spark, sf):
    """Every travelled pair through the vectorised provider call; failures become text."""
    trip_rows = _travelled(spark, sf)
    placed = distance.new_pairs(trip_rows, m.stations(spark, sf), m.known_pairs(trip_rows))
    return distance.enrich_pairs(placed, udfs.route_enricher(sample_route))


@query
def route_enrichment_sql(spark, sf):
    """The provider called from SQL text by its registered name."""
    udfs.register_route(spark, sample_route)
    view = f"pairs_{uuid.uuid4().hex}"
    trip_rows = _travelled(spark, sf)
    files.as_view(distance.new_pairs(trip_rows, m.stations(spark, sf), m.known_pairs(trip_rows)), view)
    return spark.sql(
        f"""
        SELECT source_station_id, destination_station_id, route.distance_km AS distance,
          route.duration_s AS driving_travel_time, route.error AS error
        FROM (SELECT *, {udfs.SQL_ROUTE}(source_station_lat, source_station_lon,
                destination_station_lat, destination_station_lon) AS route FROM {view})
        """
    )


# -- published history -------------------------------------------------------------------


@query
def trip_duration_buckets(spark, sf):
    return reports.with_duration(m.published_trips(spark, sf), "1995-02-01", "2001-07-31")


@query
def route_counts(spark, sf):
    return reports.route_counts(m.published_trips(spark, sf))


@query
def top_routes_history(spark, sf):
    return reports.top_history_routes(m.published_trips(spark, sf))


@query
def row_count(spark, sf):
    return m.published_trips(spark, sf).agg(F.count("*").alias("row_count"))


@query
def history_filter_load(spark, sf):
    """CSV with a header -> typed rows -> electric bikes only -> overwritten table."""
    folder = work_folder(spark, "history")
    m.published_trips(spark, sf).write.csv(f"{folder}/csv", header=True)
    rows = files.read_csv(spark, f"{folder}/csv", m.PUBLISHED_TRIPS)
    name = f"historical_trips_{uuid.uuid4().hex}"
    sinks.load_history(rows, name, f"{folder}/table")
    return files.read_table(spark, name)


def _rides(spark: SparkSession, sf: str) -> DataFrame:
    """Published trips as a table, for readers that come back often."""
    table = work_folder(spark, "rides")
    m.published_trips(spark, sf).write.parquet(table)
    return spark.read.schema(m.PUBLISHED_TRIPS).parquet(table)


@query
def rider_features(spark, sf):
    """Label and the three category indexes of every trip."""
    rides = _rides(spark, sf)
    indexed = rider_model.indexer(rides).transform(rider_model.with_label(rides))
    return indexed.select("ride_id", "label", *[F.col(c).cast("bigint").alias(c) for c in rider_model.FEATURES.values()])


@query
def rider_classifier(spark, sf):
    """Train on the trips that are not held out and score all; whether each prediction is a class and decodes to its name."""
    rides = _rides(spark, sf)
    predicted = rider_model.predict(rider_model.fit(rides.filter(~rider_model.held_out("ride_id"))), rides)
    named = (F.col("prediction") == 1) & (F.col("predicted_member_casual") == rider_model.MEMBER)
    other = (F.col("prediction") == 0) & (F.col("predicted_member_casual") == rider_model.CASUAL)
    kept = rider_model.held_out("ride_id").alias("held_out")
    return predicted.select("ride_id", "member_casual", kept, (named | other).alias("decoded"))


# -- documents ---------------------------------------------------------------------------


def _landed(spark: SparkSession, name: str, rows: DataFrame) -> str:
    folder = work_folder(spark, name)
    m.text_files(rows, folder)
    return folder


def _nested(spark: SparkSession, sf: str) -> str:
    return _landed(spark, "documents", m.nested_documents(m.table(spark, sf, "lineitem")))


@query
def json_flatten_native(spark, sf):
    typed = schemas.document_fields(schemas.TELEMETRY_STATION)
    return flatten.flatten_telemetry(files.read_json(spark, _nested(spark, sf), typed))


@query
def json_flatten_text(spark, sf):
    lines = files.read_text(spark, _nested(spark, sf))
    document = documents.parse_document(F.col("value"), schemas.TELEMETRY_STATION)
    return flatten.flatten_telemetry(lines.select(document.alias("doc")).select("doc.*"))


@query
def json_flatten_sql(spark, sf):
    """The folder as a relation in SQL, its schema inferred, flattened by lateral views."""
    view = f"documents_{uuid.uuid4().hex}"
    files.as_view(files.query_path(spark, "json", _nested(spark, sf)), view)
    return spark.sql(
        f"""
        SELECT st.* EXCEPT (ebikes), bike.* EXCEPT (range_estimate), bike.range_estimate.*, last_updated
        FROM {view} LATERAL VIEW explode(data.stations) AS st LATERAL VIEW explode(st.ebikes) AS bike
        """
    )


@query
def json_inferred_once(spark, sf):
    """Schema taken from the documents by one inference pass, then fixed for parsing text."""
    folder = _nested(spark, sf)
    inferred = files.sample_schema(spark, folder, "data.stations")["stations"].dataType
    raw = files.read_json(spark, folder, schemas.RAW_DOCUMENT)
    parsed = F.from_json("data", T.StructType([T.StructField("stations", inferred)]))
    return raw.select("last_updated", F.explode(parsed["stations"]).alias("station")).select(
        "last_updated", "station.station_id", F.size("station.ebikes").alias("n_ebikes")
    )


@query
def json_schema_infer(spark, sf):
    return documents.infer_json_schema(m.table(spark, sf, "events"), "props")


@query
def json_props_parse(spark, sf):
    parsed = F.from_json("props", "k bigint")
    return m.table(spark, sf, "events").select("event_id", parsed.alias("props")).select("event_id", "props.*")


@query
def station_info_flatten(spark, sf):
    folder = _landed(spark, "information", m.information_documents(m.table(spark, sf, "customer")))
    return flatten.flatten_station_information(files.read_json(spark, folder, schemas.RAW_DOCUMENT))


@query
def station_status_flatten(spark, sf):
    folder = _landed(spark, "status", m.status_documents(m.table(spark, sf, "orders")))
    return flatten.flatten_station_status(files.read_json(spark, folder, schemas.RAW_DOCUMENT))


@query
def route_steps_sum(spark, sf):
    """Totals over the steps of a route document per order."""
    steps = F.array(
        *[
            F.struct((F.col("o_totalprice") / n).alias("distance"), (F.col("o_custkey") / n).alias("duration"))
            for n in (1, 2, 4)
        ]
    )
    legs = F.struct(F.array(F.struct(F.array(F.struct(steps.alias("steps"))).alias("legs"))).alias("routes"))
    texts = m.table(spark, sf, "orders").select("o_orderkey", F.to_json(legs).alias("route"))
    route = F.from_json("route", schemas.ROUTE_DOCUMENT)
    totals = documents.route_totals(documents.first_leg_steps(route))
    return texts.select("o_orderkey", totals.alias("totals")).select("o_orderkey", "totals.*")


@query
def route_text_split(spark, sf):
    """Delimited route text, and error text without a delimiter, split in two."""
    km, seconds = F.round(F.col("l_extendedprice") / 1000, 1), F.col("l_quantity")
    route = F.when(F.col("l_returnflag") == "R", "Error: no road").otherwise(text.route_text(km, seconds))
    return m.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", route.alias("route")).select(
        "l_orderkey",
        "l_linenumber",
        text.route_text_distance(F.col("route")).alias("distance"),
        text.route_text_duration(F.col("route")).alias("driving_travel_time"),
    )


# -- enrichment, projections, functions --------------------------------------------------


@query
def snapshot_enrich(spark, sf):
    return enrich.enrich_telemetry(m.telemetry_bronze(m.table(spark, sf, "events")))


@query
def scalar_functions(spark, sf):
    seconds = m.epoch("o_orderdate") + F.col("o_custkey")
    user = F.concat(F.lit("clerk."), F.col("o_custkey").cast("string"), F.lit("@bike.example"))
    base = m.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", seconds.alias("s"), user.alias("user"))
    return base.select(
        "o_orderkey",
        F.md5(F.concat(F.col("o_orderkey").cast("string"), "o_orderpriority")).alias("key_md5"),
        F.col("s").cast("string").cast("bigint").alias("text_to_long"),
        F.col("s").cast("timestamp").alias("long_to_timestamp"),
        F.to_timestamp(F.col("s")).alias("epoch_to_timestamp"),
        F.from_unixtime("s").alias("epoch_text"),
        times.local_time_from_text(F.col("s")).alias("local_from_text"),
        times.local_time(F.col("s")).alias("local_by_offset"),
        times.local_time(F.col("s"), "America/New_York").alias("local_by_zone"),
        times.seconds_between(F.timestamp_seconds("s"), F.timestamp_seconds(F.col("s") + 90)).alias("seconds"),
        F.to_date(F.timestamp_seconds("s")).alias("day"),
        times.capture_stamp(F.timestamp_seconds("s")).alias("stamp"),
        F.instr("o_orderpriority", "-").alias("dash_at"),
        F.substring("o_orderpriority", 3, 4).alias("part"),
        text.schema_name(F.col("user")).alias("schema_name"),
        text.first_letter(F.col("o_orderpriority")).alias("letter"),
        text.prefixed_station_id(F.col("o_orderkey").cast("string")).alias("prefixed"),
    )


@query
def predicates(spark, sf):
    """Filters and CASE forms: equality, inequality, NULL tests, ranges, AND / OR, flags."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    rows = m.table(spark, sf, "orders").withColumn("done", status)
    price, key = F.col("o_totalprice"), F.col("o_custkey")
    kept = rows.filter(
        ((F.col("o_orderpriority") == "1-URGENT") | F.col("done").isNull() | F.expr("done is false"))
        & (F.col("o_orderkey") != key)
        & ((price > 1000) | price.between(key, key + 9.9))
    )
    return kept.select(
        "o_orderkey",
        times.duration_bucket(F.col("o_custkey")).alias("bucket"),
        F.coalesce(F.col("done"), F.lit(False)).alias("done_flag"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
    )


@query
def star_projection(spark, sf):
    """Star forms in SQL over a temporary view."""
    view = f"orders_{uuid.uuid4().hex}"
    files.as_view(m.table(spark, sf, "orders"), view)
    return spark.sql(
        f"""
        WITH shaped AS (SELECT o.* EXCEPT (o_orderpriority), named_struct('a', o_custkey) AS inner_struct FROM {view} o)
        SELECT * EXCEPT (inner_struct), inner_struct.a AS custkey_again FROM shaped
        """
    )


# -- type 1 and type 2 tables ------------------------------------------------------------


@query
def scd1_latest(spark, sf):
    return scd.latest_per_key(m.order_changes(spark, sf), ["o_custkey"], "o_orderkey")


@query
def scd1_repeated_snapshot(spark, sf):
    """Every snapshot delivered twice: one row per bike and second remains."""
    bronze = m.telemetry_bronze(m.table(spark, sf, "events"))
    rows = enrich.enrich_telemetry(bronze.unionByName(bronze))
    return scd.latest_per_key(rows, ["rideable_id", "last_updated"], "last_updated")


@query
def scd2_history(spark, sf):
    return scd.history(m.order_changes(spark, sf), ["o_custkey"], "o_orderkey", ["o_totalprice"])


@query
def scd2_current(spark, sf):
    ranges = scd.history(
        m.order_changes(spark, sf).withColumnRenamed("o_custkey", "station_id").withColumn(
            "station_id", F.col("station_id").cast("string")
        ),
        ["station_id"],
        "o_orderkey",
        ["o_totalprice"],
    )
    return scd.current_stations(ranges)


# -- streams -----------------------------------------------------------------------------


@query
def file_stream_ingest(spark, sf):
    """JSON files landing in two deliveries, flattened and appended once each."""
    folder = work_folder(spark, "ingest")
    bronze = m.telemetry_bronze(m.table(spark, sf, "events"))
    for delivery in m.waves(bronze, m.scattered("displayed_number", 2), 2):
        m.text_files(m.telemetry_documents(delivery), f"{folder}/landing")
        arriving = streams.stream_documents(spark, f"{folder}/landing", PART_FILES)
        append_stream(flatten.flatten_telemetry(arriving), f"{folder}/bronze", f"{folder}/checkpoint")
    return spark.read.schema(schemas.TELEMETRY_BRONZE).parquet(f"{folder}/bronze")


@query
def table_stream_append(spark, sf):
    """A table read as a stream, projected and appended."""
    folder = work_folder(spark, "table-stream")
    name = f"events_{uuid.uuid4().hex}"
    sinks.create_table_as(m.table(spark, sf, "events"), name, f"{folder}/table")
    rows = streams.stream_table(spark, name).select("event_id", "user_id", "event_type", "value")
    append_stream(rows, f"{folder}/out", f"{folder}/checkpoint", partition_by=["event_type"])
    return spark.read.parquet(f"{folder}/out")


def _order_stream(spark: SparkSession, sf: str, folder: str) -> Iterator[DataFrame]:
    """Order changes as a stream that gets three deliveries in no order of time."""
    changes = m.order_changes(spark, sf)
    for delivery in m.waves(changes, m.scattered("o_orderkey", 3), 3):
        delivery.write.mode("append").parquet(f"{folder}/changes")
        yield streams.stream_folder(spark, f"{folder}/changes", changes.schema)


@query
def scd1_streaming(spark, sf):
    folder = work_folder(spark, "scd1")
    target = PartitionedTable(f"{folder}/latest", key_bucket("o_custkey", buckets=4), ["o_custkey"])
    target.create(spark, m.order_changes(spark, sf).schema)
    step = upsert_latest(target, ["o_custkey"], "o_orderkey")
    for arriving in _order_stream(spark, sf, folder):
        each_batch(arriving, step, f"{folder}/checkpoint")
    return target.read(spark)


@query
def scd2_streaming(spark, sf):
    folder = work_folder(spark, "scd2")
    bucket = key_bucket("o_custkey", buckets=4)
    log = PartitionedTable(f"{folder}/log", bucket, ["o_custkey"])
    ranges = PartitionedTable(f"{folder}/ranges", bucket, ["o_custkey"])
    step = upsert_history(log, ranges, ["o_custkey"], "o_orderkey", ["o_totalprice"])
    for arriving in _order_stream(spark, sf, folder):
        each_batch(arriving, step, f"{folder}/checkpoint")
    return ranges.read(spark)


@query
def trips_streaming(spark, sf):
    """Telemetry in three deliveries, in order of time; trips appended as they end."""
    folder = work_folder(spark, "trips")
    rows = enrich.enrich_telemetry(m.telemetry_bronze(m.table(spark, sf, "events")))
    first, last = rows.agg(F.min("last_updated"), F.max("last_updated")).first()
    third = F.floor((F.col("last_updated") - first) * 3 / (last - first + 1))
    state = PartitionedTable(f"{folder}/state", key_bucket("rideable_id", buckets=4), ["rideable_id"])
    step = extend_trips(state, f"{folder}/trips", f"{folder}/late")
    for delivery in m.waves(rows, third, 3):
        delivery.write.mode("append").parquet(f"{folder}/readings")
        arriving = streams.stream_folder(spark, f"{folder}/readings", rows.schema)
        each_batch(arriving, step, f"{folder}/checkpoint")
    return read_trips(spark.read.parquet(f"{folder}/trips"))


@query
def trips_streaming_late(spark, sf):
    """Telemetry in three deliveries in no order of time: trips are set right as late readings come."""
    folder = work_folder(spark, "late-trips")
    rows = m.readings(spark, sf)
    table = PartitionedTable(f"{folder}/telemetry", time_bucket("last_updated", WEEK), ["rideable_id"])
    state = PartitionedTable(f"{folder}/state", key_bucket("rideable_id", buckets=4), ["rideable_id"])
    store = upsert_latest(table, ["rideable_id", "last_updated"], "last_updated")
    step = extend_trips(state, f"{folder}/trips", f"{folder}/late", spans_around(table))
    for delivery in m.waves(rows, m.scattered("ebike_time_id", 3), 3):
        delivery.write.mode("append").parquet(f"{folder}/readings")
        for name, work in (("table", store), ("trips", step)):
            each_batch(streams.stream_folder(spark, f"{folder}/readings", rows.schema), work, f"{folder}/{name}-checkpoint")
    return read_trips(spark.read.parquet(f"{folder}/trips"))


@query
def trips_stream_static_join(spark, sf):
    """A stream of readings, in two deliveries, joined to the table as it grows: trips whose end is in the stream."""
    folder = work_folder(spark, "stream-static")
    readings = m.readings(spark, sf)
    table = PartitionedTable(f"{folder}/telemetry", time_bucket("last_updated", WEEK), ["rideable_id"])
    store = upsert_latest(table, ["rideable_id", "last_updated"], "last_updated")
    step = join_arrivals(spans_around(table), f"{folder}/trips")
    # In no order of time: many a reading falls between two that were joined before.
    for delivery in m.waves(readings, m.scattered("ebike_time_id", 2), 2):
        delivery.write.mode("append").parquet(f"{folder}/readings")
        for name, work in (("table", store), ("trips", step)):
            each_batch(streams.stream_folder(spark, f"{folder}/readings", readings.schema), work, f"{folder}/{name}-checkpoint")
    return read_trips(spark.read.parquet(f"{folder}/trips"))


def _medallion(spark: SparkSession, sf: str) -> Medallion:
    folder = work_folder(spark, "medallion")
    landing = f"{folder}/landing"
    m.text_files(m.telemetry_documents(m.telemetry_bronze(m.table(spark, sf, "events"))), f"{landing}/{k.TELEMETRY_FEED}")
    m.text_files(m.nation_documents(m.table(spark, sf, "nation")), f"{landing}/{k.STATION_INFORMATION_FEED}")
    m.text_files(m.status_documents(m.table(spark, sf, "orders")), f"{landing}/{k.STATION_STATUS_FEED}")
    months = 30 * 86_400
    return Medallion(
        spark, landing, f"{folder}/warehouse", PART_FILES, bucket_seconds=months, history_buckets=4
    )


@query
def medallion_run(spark, sf):
    """Landing files of the three feeds, through every table, to trips with station names."""
    return _medallion(spark, sf).run()


@query
def medallion_distance_matrix(spark, sf):
    """The distance matrix as a step of the run: every travelled pair."""
    tables = _medallion(spark, sf)
    tables.run()
    return tables.matrix.read(spark)


@query
def medallion_rejects(spark, sf):
    """Broken and keyless documents among the telemetry: what lands is kept or rejected."""
    folder = work_folder(spark, "rejects")
    events = m.table(spark, sf, "events")
    whole = m.telemetry_documents(m.telemetry_bronze(events))
    broken = m.telemetry_documents(m.telemetry_bronze(events.filter("event_id % 5 = 0")))
    keyless = m.telemetry_documents(m.telemetry_bronze(events.filter("event_id % 7 = 0")))
    soon = F.regexp_replace("value", '"last_updated":[0-9]+', '"last_updated":"soon"')
    documents = whole.unionByName(broken.select(F.expr("left(value, 40)").alias("value"))).unionByName(
        keyless.select(soon.alias("value"))
    )
    m.text_files(documents, f"{folder}/landing/{k.TELEMETRY_FEED}")
    tables = Medallion(spark, f"{folder}/landing", f"{folder}/warehouse", PART_FILES, bucket_seconds=30 * 86_400)
    tables.ingest_feed(k.TELEMETRY_FEED)
    tables.upsert_telemetry()
    count = F.count("*")
    lost = spark.read.parquet(f"{folder}/warehouse/bronze/{k.TELEMETRY_FEED}_rejects").agg(count.alias("broken"))
    bad = spark.read.parquet(f"{folder}/warehouse/silver/telemetry_rejects").agg(count.alias("keyless"))
    kept = tables.bronze(k.TELEMETRY_FEED).agg(count.alias("rows"))
    return lost.join(bad).join(kept).select("broken", "keyless", (F.col("rows") - F.col("keyless")).alias("kept"))


# -- UDFs --------------------------------------------------------------------------------


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return m.table(spark, sf, "conversations").select("conv_id", "turn", "text")


@query
def udf_first_letter_scalar(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", udfs.first_letter_scalar("text").alias("letter"))


@query
def udf_first_letter_decorated(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", udfs.first_letter_decorated("text").alias("letter"))


@query
def udf_first_letter_pandas(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", udfs.first_letter_vectorised("text").alias("letter"))


@query
def udf_first_letter_pandas_call(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", udfs.first_letter_vectorised_call("text").alias("letter"))


@query
def udf_first_letter_iterator(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", udfs.first_letter_iterator("text").alias("letter"))


@query
def udf_first_letter_sql(spark, sf):
    udfs.register(spark)
    view = f"turns_{uuid.uuid4().hex}"
    files.as_view(_turns(spark, sf), view)
    return spark.sql(f"SELECT conv_id, turn, {udfs.SQL_FIRST_LETTER}(text) AS letter FROM {view}")


@query
def first_letter_native(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", text.first_letter(F.col("text")).alias("letter"))


# -- scans and sinks ---------------------------------------------------------------------


@query
def csv_header_scan(spark, sf):
    folder = work_folder(spark, "csv")
    m.table(spark, sf, "customer").write.csv(folder, header=True)
    return files.read_csv_text(spark, folder)


@query
def csv_infer_scan(spark, sf):
    folder = work_folder(spark, "csv")
    m.table(spark, sf, "orders").write.csv(folder, header=True)
    rows = files.read_csv(spark, folder)
    # The inferred width of whole numbers follows the data; the result is fixed.
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


@query
def text_dir_scan(spark, sf):
    folder = work_folder(spark, "text")
    m.table(spark, sf, "events").select("props").write.text(folder)
    return files.query_path(spark, "text", folder)


@query
def preview_rows(spark, sf):
    """A look at the first hundred readings."""
    rows = m.telemetry_bronze(m.table(spark, sf, "events")).withColumn("n", F.col("displayed_number").cast("bigint"))
    return sinks.first_rows(rows.orderBy("n"), 100).drop("n")


@query
def file_listing(spark, sf):
    """Every file of a landing folder that the events were written to, by type of event."""
    folder = work_folder(spark, "listing")
    m.table(spark, sf, "events").write.partitionBy("event_type").json(folder)
    listed = files.list_files(spark, folder, recursive=True)
    kind = F.regexp_extract("path", "event_type=([^/]+)/", 1)
    return listed.groupBy(kind.alias("event_type")).agg(F.min(F.col("size") > 0).alias("filled"))


@query
def filename_metadata(spark, sf):
    """Capture time and run id out of landing names: a snapshot per day, the day of year as run id."""
    folder = work_folder(spark, "names")
    ts = F.col("ts").cast("timestamp")
    name = F.concat_ws(
        "_", F.lit(k.TELEMETRY_FEED), times.capture_stamp(F.date_trunc("day", ts)), F.dayofyear(ts).cast("string")
    )
    landed = m.table(spark, sf, "events").select("event_id", "user_id", name.alias("snapshot"))
    sinks.write_clustered(landed, folder, ["user_id"], ["snapshot"])
    rows = files.with_capture_columns(spark.read.parquet(folder))
    return rows.select("event_id", "user_id", "capture_time", "run_id")


MEMBER_ROWS = 10_000


def _pack(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    """One zip archive on the shared disk per task, with a CSV member per ten thousand rows."""
    system, place = open_place(folder)
    name, count = f"{place}/{uuid.uuid4().hex}.zip", 0
    with system.open_output_stream(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for rows in batches:
            for at in range(0, len(rows), MEMBER_ROWS):
                archive.writestr(f"trips-{count}.csv", rows[at : at + MEMBER_ROWS].to_csv(index=False))
                count += 1
    yield pd.DataFrame({"name": [name], "members": [count]})


@query
def zip_csv_scan(spark, sf):
    lines = m.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    folder = work_folder(spark, "archives")
    system, place = open_place(folder)
    system.create_dir(place, recursive=True)
    # Only the archives that the finished job names are read; a lost task may have left another one.
    landed = lines.mapInPandas(lambda it: _pack(it, folder), "name string, members long").collect()
    names = [r.name.rsplit("/", 1)[1] for r in landed]
    found = archives.read_archives(spark, folder, "*.zip").filter(F.element_at(F.split("path", "/"), -1).isin(names))
    rows = archives.zipped_csv_rows(found, "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string")
    return rows.drop("archive", "member")


@query
def ctas_roundtrip(spark, sf):
    name = f"part_copy_{uuid.uuid4().hex}"
    view = f"{name}_vw"
    files.as_view(m.table(spark, sf, "part"), view)
    path = work_folder(spark, "ctas")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS SELECT * FROM {view}")
    return files.read_table(spark, name)


@query
def cluster_write(spark, sf):
    """Lines laid out by supplier and order, read back."""
    folder = work_folder(spark, "cluster")
    sinks.write_clustered(m.table(spark, sf, "lineitem"), folder, ["l_suppkey", "l_orderkey"])
    return spark.read.parquet(folder)


@query
def cluster_layout(spark, sf):
    """How many files of the laid out table hold a range of the first key that lies within another's."""
    folder = work_folder(spark, "layout")
    sinks.write_clustered(m.table(spark, sf, "lineitem"), folder, ["l_suppkey", "l_orderkey"])
    file = F.col("_metadata.file_path").alias("file")
    ranges = spark.read.parquet(folder).groupBy(file).agg(F.min("l_suppkey").alias("low"), F.max("l_suppkey").alias("high"))
    # Sorted by its start, a range lies within another if one that began before ends later.
    earlier = Window.orderBy("low").rangeBetween(Window.unboundedPreceding, -1)
    inside = ranges.withColumn("reach", F.max("high").over(earlier)).filter("reach > high")
    return inside.agg(F.count("*").alias("files_within_others"))


@query
def materialized_view_refresh(spark, sf):
    """A recomputed view: a first version, then the one that readers see."""
    view = MaterializedView(work_folder(spark, "view"))
    trip_rows = m.trips(spark, sf)
    counts = trip_rows.groupBy("pickup_station_id").agg(F.count("*").alias("trips"))
    view.refresh(counts.withColumn("trips", F.lit(0).cast("bigint")))
    view.refresh(counts)
    return view.read(spark)


@query
def previous_and_next_order(spark, sf):
    """Both neighbours of each order of a customer."""
    near = with_neighbours(
        m.order_changes(spark, sf), ["o_custkey"], ["o_orderkey"], carry=["o_orderkey"], before="prev", after="next"
    )
    return near.select(
        "o_custkey", "o_orderkey", F.col("prev.o_orderkey").alias("prev_key"), F.col("next.o_orderkey").alias("next_key")
    )
