"""The given tables in the shape of the feeds, for queries and tests.

Every mapping reads whole tables. Feed documents are built row by row, so no table is
gathered into documents by a grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow import schemas
from bikeflow.functions import text
from bikeflow.operators.enrich import enrich_telemetry
from bikeflow.operators.scd import latest_per_key
from bikeflow.operators.trips import reconstruct_trips

NATIONS = 25
# Documents in a landing file. Compressed files are not split, so this bounds what one reading task opens at least.
FILE_DOCUMENTS = 250_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def epoch(column: str) -> Column:
    return F.unix_timestamp(F.col(column).cast("timestamp"))


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the checking side stores them."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


# -- telemetry from events ---------------------------------------------------------------


def telemetry_bronze(events: DataFrame) -> DataFrame:
    """One e-bike reading per event."""
    number = F.from_json("props", "k bigint")["k"]
    return events.select(
        epoch("ts").cast("string").alias("last_updated"),
        text.prefixed_station_id((number % NATIONS).cast("string")).alias("station_id"),
        (F.floor("value") % 101).alias("battery_charge_percentage"),
        F.col("event_id").cast("string").alias("displayed_number"),
        number.alias("docking_capability"),
        (F.col("event_type") == "view").alias("is_lbs_internal_rideable"),
        F.col("event_type").alias("make_and_model"),
        F.col("user_id").cast("string").alias("rideable_id"),
        (F.col("value") % 17).alias("conservative_range_miles"),
        (F.col("value") % 31).alias("estimated_range_miles"),
    )


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Telemetry silver rows, one per bike and second."""
    silver = enrich_telemetry(telemetry_bronze(table(spark, sf, "events")))
    return latest_per_key(silver, ["rideable_id", "last_updated"], "last_updated")


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return reconstruct_trips(readings(spark, sf))


def telemetry_documents(bronze: DataFrame) -> DataFrame:
    """A feed document per telemetry row: its station, and a second one without e-bikes."""
    bike = F.struct(
        "battery_charge_percentage",
        "displayed_number",
        "docking_capability",
        "is_lbs_internal_rideable",
        "make_and_model",
        F.struct("conservative_range_miles", "estimated_range_miles").alias("range_estimate"),
        "rideable_id",
    )
    full = F.struct(F.array(bike).alias("ebikes"), F.col("station_id"))
    empty = F.from_json(F.lit('{"ebikes": [], "station_id": "empty"}'), schemas.TELEMETRY_STATION)
    return _document(F.array(full.cast(schemas.TELEMETRY_STATION), empty), bronze)


def _document(stations: Column, rows: DataFrame) -> DataFrame:
    document = F.struct(
        F.struct(stations.alias("stations")).alias("data"),
        F.col("last_updated").cast("bigint").alias("last_updated"),
        F.lit(60).cast("bigint").alias("ttl"),
        F.lit("1.1").alias("version"),
    )
    return rows.select(F.to_json(document).alias("value"))


# -- nested documents from lineitem ------------------------------------------------------


def nested_documents(lineitem: DataFrame) -> DataFrame:
    """A document per line: a station with two e-bikes, one without a range, and an empty station."""
    quantity = F.col("l_quantity").cast("bigint")
    line = F.col("l_linenumber").cast("bigint")
    reach = F.struct(
        F.col("l_discount").alias("conservative_range_miles"), F.col("l_tax").alias("estimated_range_miles")
    )

    def bike(charge: Column, shown: str, reach: Column, prefix: str, key: str) -> Column:
        return F.struct(
            charge.alias("battery_charge_percentage"),
            F.col(shown).alias("displayed_number"),
            line.alias("docking_capability"),
            (F.col("l_returnflag") == "R").alias("is_lbs_internal_rideable"),
            F.col("l_linestatus").alias("make_and_model"),
            reach.alias("range_estimate"),
            F.concat(F.lit(prefix), F.col(key).cast("string")).alias("rideable_id"),
        )

    bikes = F.array(
        bike(quantity, "l_returnflag", reach, "P", "l_partkey"),
        bike(line, "l_linestatus", F.when(F.lit(False), reach), "O", "l_orderkey"),
    )
    full = F.struct(bikes.alias("ebikes"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("station_id"))
    empty = F.from_json(F.lit('{"ebikes": [], "station_id": "empty"}'), schemas.TELEMETRY_STATION)
    stations = F.array(full.cast(schemas.TELEMETRY_STATION), empty)
    return _document(stations, lineitem.withColumn("last_updated", epoch("l_shipdate")))


# -- stations ----------------------------------------------------------------------------


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Station dimension from nations, under the id form of telemetry."""
    return table(spark, sf, "nation").select(
        text.prefixed_station_id(F.col("n_nationkey").cast("string")).alias("station_id"),
        F.col("n_name").alias("name"),
        (F.lit(42.3) + F.lit(0.004) * F.col("n_nationkey")).alias("lat"),
        (F.lit(-71.1) + F.lit(0.01) * F.col("n_regionkey")).alias("lon"),
    )


def information_documents(customers: DataFrame) -> DataFrame:
    """Station information documents: two stations per customer row."""

    def station(suffix: str, capacity: Column) -> Column:
        return F.struct(
            F.concat(F.col("c_custkey").cast("string"), F.lit(suffix)).alias("station_id"),
            F.col("c_name").alias("name"),
            (F.lit(42.3) + F.lit(0.004) * F.col("c_nationkey")).alias("lat"),
            F.col("c_acctbal").alias("lon"),
            capacity.cast("bigint").alias("capacity"),
        )

    pair = F.array(station("a", F.col("c_nationkey")), station("b", F.lit(15)))
    return _document(pair, customers.withColumn("last_updated", F.lit(1704067200) + F.col("c_custkey")))


def nation_documents(nations: DataFrame) -> DataFrame:
    """Two station information snapshots of the nations: provisional names, then the real ones."""

    def at(seconds: int, name: Column) -> DataFrame:
        station = F.struct(
            F.col("n_nationkey").cast("string").alias("station_id"),
            name.alias("name"),
            (F.lit(42.3) + F.lit(0.004) * F.col("n_nationkey")).alias("lat"),
            (F.lit(-71.1) + F.lit(0.01) * F.col("n_regionkey")).alias("lon"),
            F.lit(15).cast("bigint").alias("capacity"),
        )
        return _document(F.array(station), nations.withColumn("last_updated", F.lit(seconds)))

    return at(1704067200, F.concat(F.lit("planned "), F.col("n_name"))).unionByName(
        at(1704153600, F.col("n_name"))
    )


def status_documents(orders: DataFrame) -> DataFrame:
    """Station status documents: one station per order."""
    station = F.struct(
        F.col("o_custkey").cast("string").alias("station_id"),
        (F.col("o_orderkey") % 20).alias("num_bikes_available"),
        (F.col("o_orderkey") % 7).alias("num_docks_available"),
        (F.col("o_orderkey") % 5).alias("num_ebikes_available"),
        F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).cast("bigint").alias("is_renting"),
        epoch("o_orderdate").alias("last_reported"),
    )
    return _document(
        F.array(station), orders.withColumn("last_updated", epoch("o_orderdate") + F.col("o_orderkey") % 60)
    )


# -- published trips ---------------------------------------------------------------------


def published_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Historical trips: a line per trip, from the customer's nation to the supplier's."""
    nation = table(spark, sf, "nation")
    customers = (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("start_station_name"))
    )
    suppliers = (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("supplier_nation"))
    )
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    start = epoch("o_orderdate") + F.col("l_partkey") * 37 % 86400
    length = F.col("l_suppkey") * F.col("l_linenumber") * 13 % 5000
    return (
        lines.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ride_id"),
            F.when(F.col("l_returnflag") == "R", "classic_bike").otherwise("electric_bike").alias("rideable_type"),
            F.timestamp_seconds(start).alias("started_at"),
            F.timestamp_seconds(start + length).alias("ended_at"),
            "start_station_name",
            F.when(F.col("l_linenumber") != 7, F.col("supplier_nation")).alias("end_station_name"),
            F.when(F.col("o_orderstatus") == "F", "member").otherwise("casual").alias("member_casual"),
        )
    )


PUBLISHED_TRIPS = (
    "ride_id string, rideable_type string, started_at timestamp, ended_at timestamp, "
    "start_station_name string, end_station_name string, member_casual string"
)


# -- changing entity and known pairs -----------------------------------------------------


def order_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that change with each order: sequence is the order key."""
    return table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


def known_pairs(trip_rows: DataFrame) -> DataFrame:
    """Station pairs that the distance matrix holds already: a third of the travelled ones."""

    def number(column: str) -> Column:
        return F.substring_index(column, "_", -1).cast("int")

    held = (number("pickup_station_id") + number("dropoff_station_id")) % 3 == 0
    return trip_rows.filter(held).select(
        F.col("pickup_station_id").alias("source_station_id"),
        F.col("dropoff_station_id").alias("destination_station_id"),
    ).distinct()


def waves(df: DataFrame, by: Column, count: int) -> list[DataFrame]:
    """The rows in ``count`` deliveries that together hold all of them."""
    return [df.filter(by == i) for i in range(count)]


def scattered(column: str, count: int) -> Column:
    """Delivery number that has nothing to do with the order of the data."""
    return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")


def text_files(documents: DataFrame, folder: str, mode: str = "append", per_file: int = FILE_DOCUMENTS) -> None:
    """Land documents as compressed JSON files, one document per line, ``per_file`` of them at most in a file.

    Feed documents are mostly the names of their fields, so as plain text they take many times the rows they hold.
    """
    writer = documents.select("value").write.mode(mode).option("compression", "lz4").option("maxRecordsPerFile", per_file)
    writer.format("text").save(folder)

