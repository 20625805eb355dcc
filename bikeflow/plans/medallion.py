"""Landing folder to trips with station names, one incremental step per table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow import schemas
from bikeflow.constants import END_AT, STATION_INFORMATION_FEED, STATION_STATUS_FEED, TELEMETRY_FEED
from bikeflow.functions.udfs import great_circle_route
from bikeflow.operators import distance, enrich, flatten, scd
from bikeflow.operators.sinks import write_clustered
from bikeflow.operators.stations import with_station_names
from bikeflow.session import work_folder
from bikeflow.sources.streams import stream_documents, stream_folder
from bikeflow.streaming.ingest import each_batch, merge_batches, read_batches
from bikeflow.streaming.partitions import BUCKET, Folder, MaterializedView, PartitionedTable, key_bucket, own_bucket, time_bucket
from bikeflow.streaming.trips import each_once, extend_trips, read_trips, spans_around
from bikeflow.streaming.upserts import upsert_history, upsert_latest

# Text of documents that the reader could not take as they are.
BROKEN = "document"

UNTRACKED = ("timestamp_utc", "timestamp_local", "last_updated")
NAMES = ("pickup_station_name", "dropoff_station_name")
MATRIX_BUCKETS = 16


@dataclass
class Medallion:
    """Tables of one warehouse folder, and the steps that bring them up to date.

    Every step takes up what is new since its last run and can be run again at any time.
    ``glob`` selects the landing files; ``max_files`` bounds a micro-batch.
    ``bucket_seconds`` is the time span that an upsert rewrites as a unit; ``history_buckets`` deals stations out by hash,
    and without it every station has a partition of its own. Landing files that are done move below
    ``archive``, if given. ``keep_batches`` is how many folders of micro-batches may stand before they are merged.
    """

    spark: SparkSession
    landing: str
    warehouse: str
    glob: str = "*.json"
    max_files: int | None = 10_000
    zone: str | None = None
    bucket_seconds: int = 86_400
    history_buckets: int | None = None
    bike_buckets: int = 64
    archive: str | None = None
    keep_batches: int = 32

    def __post_init__(self) -> None:
        span = time_bucket("last_updated", self.bucket_seconds)
        by_station = key_bucket("station_id", buckets=self.history_buckets) if self.history_buckets else own_bucket("station_id")
        by_bike = key_bucket("rideable_id", buckets=self.bike_buckets)
        by_source = key_bucket("source_station_id", buckets=MATRIX_BUCKETS)
        self.telemetry = PartitionedTable(self._path("silver/telemetry"), span, ["rideable_id", "last_updated"])
        self.status = PartitionedTable(self._path("silver/station_status"), span, ["station_id", "last_updated"])
        self.station_log = PartitionedTable(self._path("silver/station_log"), by_station, ["station_id"])
        self.station_history = PartitionedTable(self._path("silver/station_history"), by_station, ["station_id", END_AT])
        self.current_stations = MaterializedView(self._path("gold/stations"))
        self.last_readings = PartitionedTable(self._path("gold/last_readings"), by_bike, ["rideable_id"])
        self.matrix = PartitionedTable(
            self._path("gold/distance_matrix"), by_source, ["source_station_id"], schema=schemas.DISTANCE_MATRIX
        )
        day = F.date_format("trip_start_time_local", "yyyy-MM-dd")
        self.named_trips = PartitionedTable(self._path("gold/trips_with_names"), day, ["trip_start_time_local"])
        # The stations that the named trips have their names from.
        self.names_given = MaterializedView(self._path("gold/names_given"))

    def _path(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"

    def _checkpoint(self, name: str) -> str:
        return self._path(f"_checkpoints/{name}")

    # bronze: documents to rows

    def _bronze(self, feed: str, station: str, flat: Callable[[DataFrame], DataFrame]) -> None:
        landed = f"{self.landing}/{feed}"
        done = f"{self.archive.rstrip('/')}/{feed}" if self.archive else None
        documents = stream_documents(self.spark, landed, self.glob, station, self.max_files, broken=BROKEN, archive=done)
        target, rejects = self._path(f"bronze/{feed}"), self._path(f"bronze/{feed}_rejects")

        def write(batch: DataFrame, batch_id: int) -> None:
            bad = batch.filter(F.col(BROKEN).isNotNull()).select("last_updated", BROKEN)
            bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
            # Files hold ranges of stations, which their statistics skip by.
            write_clustered(flat(batch.filter(F.col(BROKEN).isNull())), f"{target}/batch={batch_id}", ["station_id"])

        each_batch(documents, write, self._checkpoint(f"bronze_{feed}"))

    def _bronze_stream(self, feed: str, schema: str) -> DataFrame:
        return stream_folder(self.spark, self._path(f"bronze/{feed}"), schema, max_files=self.max_files)

    def ingest_feed(self, feed: str) -> None:
        """Documents of one feed to rows; broken ones go to the feed's rejects."""
        station, flat = {
            TELEMETRY_FEED: (schemas.TELEMETRY_STATION, flatten.flatten_telemetry),
            STATION_INFORMATION_FEED: (schemas.INFORMATION_STATION, flatten.flatten_station_information),
            STATION_STATUS_FEED: (schemas.STATUS_STATION, flatten.flatten_station_status),
        }[feed]
        self._bronze(feed, station, flat)

    def ingest(self) -> None:
        for feed in (TELEMETRY_FEED, STATION_INFORMATION_FEED, STATION_STATUS_FEED):
            self.ingest_feed(feed)

    def bronze(self, feed: str) -> DataFrame:
        """All rows of one feed so far."""
        return read_batches(self.spark, self._path(f"bronze/{feed}"))

    # silver: keyed tables

    def upsert_telemetry(self) -> None:
        rows = enrich.enrich_telemetry(
            self._bronze_stream(TELEMETRY_FEED, schemas.TELEMETRY_BRONZE), self.zone
        )
        keys = ["rideable_id", "last_updated"]
        step = upsert_latest(self.telemetry, keys, "last_updated", self._path("silver/telemetry_rejects"))
        each_batch(rows, step, self._checkpoint("silver_telemetry"))

    def upsert_status(self) -> None:
        rows = enrich.enrich_station_status(
            self._bronze_stream(STATION_STATUS_FEED, schemas.STATUS_BRONZE), self.zone
        )
        keys = ["station_id", "last_updated"]
        step = upsert_latest(self.status, keys, "last_updated", self._path("silver/status_rejects"))
        each_batch(rows, step, self._checkpoint("silver_status"))

    def upsert_stations(self) -> None:
        rows = enrich.enrich_station_information(
            self._bronze_stream(STATION_INFORMATION_FEED, schemas.INFORMATION_BRONZE), self.zone
        )
        step = upsert_history(
            self.station_log,
            self.station_history,
            ["station_id"],
            "last_updated",
            UNTRACKED,
            rejects=self._path("silver/station_rejects"),
        )
        each_batch(rows, step, self._checkpoint("silver_stations"))

    # gold: trips and views

    def extend_trips(self) -> None:
        rows = enrich.enrich_telemetry(
            self._bronze_stream(TELEMETRY_FEED, schemas.TELEMETRY_BRONZE), self.zone
        )
        step = extend_trips(
            self.last_readings, self._path("gold/trips"), self._path("gold/late_readings"), spans_around(self.telemetry)
        )
        each_batch(rows, step, self._checkpoint("gold_trips"))

    def trips(self) -> DataFrame:
        return read_trips(read_batches(self.spark, self._path("gold/trips")))

    def refresh_stations(self) -> None:
        """Recompute the current stations."""
        self.current_stations.refresh(scd.current_stations(self.station_history.read(self.spark)))

    def name_trips(self) -> None:
        """Bring the trips with names up to date: new and withdrawn trips, and the trips of stations renamed since.

        Only days that hold such trips are rewritten.
        """
        stations = self.current_stations.read(self.spark)
        given = self.names_given.read(self.spark)
        if given is not None and self.named_trips.buckets(self.spark):
            self._rename(stations, given)
        self.names_given.refresh(stations.select("station_id", "name"))

        folder = self._path("gold/trips")
        if not Folder(self.spark, folder).names():
            return
        kind = F.regexp_extract("_metadata.file_path", "kind=([a-z]+)", 1).alias("kind")
        schema = self.spark.read.parquet(folder).drop("batch", "kind").schema
        rows = stream_folder(self.spark, folder, schema, max_files=self.max_files).select("*", kind)
        each_batch(rows, lambda batch, number: self._add_named(batch, stations, number), self._checkpoint("gold_named"))

    def _add_named(self, batch: DataFrame, stations: DataFrame, number: int) -> None:
        gone = batch.filter("kind = 'withdrawn'").select("trip_id").distinct()
        new = each_once(batch)
        named = with_station_names(new, stations)
        self.named_trips.create(self.spark, named.schema)

        def change(stored: DataFrame, _: list[str]) -> DataFrame:
            arrived = batch.filter("kind != 'withdrawn'").select("trip_id")
            kept = stored.join(arrived, "trip_id", "left_anti").select(*named.columns)
            return kept.unionByName(named).join(gone, "trip_id", "left_anti").select(*named.columns)

        self.named_trips.merge(batch.drop("kind"), change, number)

    def _rename(self, stations: DataFrame, given: DataFrame) -> None:
        old = given.select("station_id", F.col("name").alias("old"), F.lit(True).alias("known"))
        both = stations.select("station_id", "name").join(old, "station_id", "full")
        changed = both.filter(F.col("known").isNull() | ~F.col("name").eqNullSafe(F.col("old"))).select("station_id")
        if changed.isEmpty():
            return
        stored = self.named_trips.read(self.spark, named=True)
        ends = (stored.select(BUCKET, F.col(f"{role}_station_id").alias("station_id")) for role in ("pickup", "dropoff"))
        first, second = (rows.join(changed, "station_id", "left_semi").select(BUCKET).distinct() for rows in ends)
        days = [r[0] for r in first.union(second).distinct().collect()]  # partitions of the table at most
        if days:
            self.named_trips.merge(stored.drop(BUCKET).limit(0), lambda kept, _: with_station_names(kept.drop(*NAMES), stations), "names", days)

    def refresh_views(self) -> None:
        """Bring the current stations and the trips with names up to date."""
        self.refresh_stations()
        self.name_trips()

    def extend_matrix(
        self,
        router: Callable[..., Column] = great_circle_route,
        tasks: int | None = None,
    ) -> DataFrame:
        """Add the new travelled station pairs to the distance matrix; returns failed pairs."""
        known = self.matrix.create(self.spark).read(self.spark)
        answers = work_folder(self.spark, "routes")
        added, failed = distance.extend_matrix(
            self.named_trips.read(self.spark), self.current_stations.read(self.spark), known, router, tasks, answers
        )
        pair = ["source_station_id", "destination_station_id"]
        self.matrix.merge(added, lambda stored, _: stored.join(added.select(*pair), pair, "left_anti").unionByName(added))
        return failed

    def tables(self) -> dict[str, DataFrame]:
        """The tables as they are now, by name."""
        stored = {
            "telemetry": self.telemetry,
            "station_status": self.status,
            "station_history": self.station_history,
            "stations": self.current_stations,
            "distance_matrix": self.matrix,
            "trips_with_names": self.named_trips,
        }
        return {name: table.read(self.spark) for name, table in stored.items()} | {"trips": self.trips()}

    def register_views(self) -> None:
        """Temporary views of the tables, for SQL."""
        for name, frame in self.tables().items():
            if frame is not None:
                frame.createOrReplaceTempView(name)

    def tidy(self) -> None:
        """Merge the folders of micro-batches, which all streams of a run have taken up by its end."""
        for feed in (TELEMETRY_FEED, STATION_INFORMATION_FEED, STATION_STATUS_FEED):
            merge_batches(self.spark, self._path(f"bronze/{feed}"), self.keep_batches)
        merge_batches(self.spark, self._path("gold/trips"), self.keep_batches, ["kind"])

    def run(self) -> DataFrame:
        """All steps once, in order, the distance matrix with the built-in route; returns the trips with station names."""
        self.ingest()
        self.upsert_telemetry()
        self.upsert_status()
        self.upsert_stations()
        self.extend_trips()
        self.refresh_views()
        self.extend_matrix()
        self.tidy()
        return self.named_trips.read(self.spark)
