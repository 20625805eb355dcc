"""Parquet tables that change by whole partitions, and views that switch by the catalog.

A change is written aside first and then takes the place of the partitions it falls in by Spark's dynamic partition
overwrite. A run that dies between the two finds the finished copy and only repeats the second write; one that
dies before leaves the table as it was.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bikeflow.operators.neighbours import range_count
from bikeflow.operators.sinks import CODEC, write_clustered

BUCKET = "bucket"
_STAGED, _SCHEMA = "_staged", "_schema"
# Rows that a task gathers and sorts for a partition, and bytes of files that a task sorts to take them into place.
GATHERED_ROWS = 1_000_000
TAKEN_BYTES = "16m"
_SPLIT = "spark.sql.files.maxPartitionBytes"


class Folder:
    """Small files and entries of one folder, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, name: str = "") -> list[str]:
        path, fs = self._at(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def exists(self, name: str) -> bool:
        path, fs = self._at(name)
        return fs.exists(path)

    def delete(self, name: str) -> None:
        path, fs = self._at(name)
        fs.delete(path, True)

    def put(self, name: str, value: object) -> None:
        """Write a small file under another name first: it is there whole or not at all."""
        aside, fs = self._at(f"{name}.new")
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        place, _ = self._at(name)
        fs.delete(place, False)
        if not fs.rename(aside, place):
            raise OSError(f"cannot write {name} in {self.path}")

    def get(self, name: str) -> object | None:
        path, fs = self._at(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()


class PartitionedTable:
    """A table in partitions of ``bucket``, a text computed from the row: what a change rewrites as a unit.

    For keys that hold a time take the day or hour, so that a batch touches the recent partitions only, for few
    keys the key itself, else a hash of the key.
    """

    def __init__(self, path: str, bucket: Column, cluster_by: Iterable[str] = (), schema: str | StructType | None = None):
        self.path = path.rstrip("/")
        self.bucket = bucket.cast("string")
        self.cluster_by = list(cluster_by)
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def create(self, spark: SparkSession, schema: StructType | None = None) -> PartitionedTable:
        """The table without rows, if it is not there yet: readers find its columns before the first change."""
        folder = Folder(spark, self.path)
        if not folder.exists(_SCHEMA):
            folder.put(_SCHEMA, json.loads((schema or self.schema).json()))
        return self

    def columns(self, spark: SparkSession) -> StructType | None:
        held = Folder(spark, self.path).get(_SCHEMA)
        return StructType.fromJson(held) if held else self.schema

    def buckets(self, spark: SparkSession) -> list[str]:
        """Names of the partitions there are."""
        return [n.removeprefix(f"{BUCKET}=") for n in Folder(spark, self.path).names() if n.startswith(f"{BUCKET}=")]

    def read(self, spark: SparkSession, buckets: Iterable[str] | None = None, named: bool = False) -> DataFrame | None:
        """All rows, or those of some partitions: only these are opened. ``named`` adds the partition's name as a column.

        None if there is neither a row nor a known schema.
        """
        schema = self.columns(spark)
        if schema is None:
            return None
        if not Folder(spark, self.path).exists(""):
            return spark.createDataFrame([], _with_bucket(schema) if named else schema)
        rows = spark.read.schema(_with_bucket(schema)).parquet(self.path)
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
        return rows if named else rows.drop(BUCKET)

    def merge(
        self,
        batch: DataFrame,
        change: Callable[[DataFrame, list[str]], DataFrame],
        number: int | str = "run",
        buckets: Iterable[str] = (),
    ) -> list[str]:
        """Replace the partitions that ``batch`` falls in, and ``buckets``, by what ``change(stored, names)`` gives for them.

        Returns the names of the partitions. A merge of the same batch under the same number, as after a crash, is not
        computed again if its result had been written. The stored rows are as before the merge in both cases.
        """
        spark = batch.sparkSession
        self.create(spark, batch.schema)
        folder, staged = Folder(spark, self.path), f"{_STAGED}/step={number}"
        # What the batch is, beside where it falls: two sums per partition.
        print_of = F.sum(F.xxhash64(*batch.columns).cast("decimal(38,0)")).cast("string")
        falls = batch.groupBy(self.bucket.alias(BUCKET)).agg(F.count("*").alias("n"), print_of.alias("print")).collect()
        mark = {"falls": sorted([r[BUCKET], r["n"], r["print"]] for r in falls), "more": sorted(buckets)}
        names = sorted({r[BUCKET] for r in falls} | set(buckets))
        if not names:
            return names
        if folder.get(f"{staged}.done") != mark:
            folder.delete(f"{staged}.done")
            rows = change(self.read(spark, names), names).withColumn(BUCKET, self.bucket)
            write_clustered(rows, f"{self.path}/{staged}", self.cluster_by, [BUCKET], **self._shares(spark, names, mark["falls"]))
            self._written(spark, staged, mark)
        self._take(spark, staged, names)
        for name in folder.names(_STAGED):
            if not name.startswith(f"step={number}"):
                folder.delete(f"{_STAGED}/{name}")
        return names

    def _shares(self, spark: SparkSession, names: list[str], falls: list[list]) -> dict[str, int]:
        """How a merge deals its rows out, so that a task holds no more of a partition as partitions grow."""
        rows = {name: n for name, n, _ in falls}
        for r in self.read(spark, names, named=True).groupBy(BUCKET).count().collect():
            rows[r[BUCKET]] = rows.get(r[BUCKET], 0) + r["count"]
        pieces = -(-max(rows.values(), default=0) // GATHERED_ROWS)
        return {"pieces": pieces, "tasks": max(range_count(spark), -(-sum(rows.values()) // GATHERED_ROWS))} if pieces > 1 else {}

    def _written(self, spark: SparkSession, staged: str, mark: dict) -> None:
        Folder(spark, self.path).put(f"{staged}.done", mark)

    def _take(self, spark: SparkSession, staged: str, names: list[str]) -> None:
        """The copy aside into place; partitions that it has no rows for go."""
        folder = Folder(spark, self.path)
        there = {n.removeprefix(f"{BUCKET}=") for n in folder.names(staged)}
        split = spark.conf.get(_SPLIT)
        spark.conf.set(_SPLIT, TAKEN_BYTES)
        try:
            rows = spark.read.schema(_with_bucket(self.columns(spark))).parquet(f"{self.path}/{staged}")
            rows = rows.sortWithinPartitions(BUCKET, *self.cluster_by)
            writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
            writer.partitionBy(BUCKET).parquet(self.path)
        finally:
            spark.conf.set(_SPLIT, split)
        for name in set(names) - there:
            folder.delete(f"{BUCKET}={name}")


def _with_bucket(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BUCKET, StringType())])


def key_bucket(*keys: str, buckets: int = 64) -> Column:
    """Partitions by key hash, for many keys without a time."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def own_bucket(key: str) -> Column:
    """A partition per key, for dimensions of few thousand keys: a change of one rewrites its rows only."""
    safe = F.regexp_replace(F.substring(F.col(key), 1, 60), "[^A-Za-z0-9_]", "_")
    return F.concat(safe, F.lit("-"), F.hex(F.xxhash64(key)))


def time_bucket(epoch: str, seconds: int = 86_400) -> Column:
    """Partitions by a span of an epoch column that is part of the key, named by its UTC start.

    Choose the span by density: a micro-batch rewrites the spans it falls in, and each span
    gets files of its own.
    """
    start = F.floor(F.col(epoch) / F.lit(seconds)) * F.lit(seconds)
    return F.date_format(F.timestamp_seconds(start), "yyyy-MM-dd-HHmmss")


class MaterializedView:
    """A recomputed result under a name of the catalog.

    Each refresh writes a folder of its own, and one statement points the view at it when it is whole. A reader that
    has opened the view before goes on with the files it began with.
    """

    def __init__(self, path: str, name: str | None = None, cluster_by: Iterable[str] = ()):
        self.path = path.rstrip("/")
        self.name = name or f"bikeflow_{hashlib.md5(self.path.encode()).hexdigest()}"
        self.cluster_by = list(cluster_by)

    def _folders(self, spark: SparkSession) -> list[int]:
        """Numbers of the whole results, newest first."""
        folder = Folder(spark, self.path)
        numbers = (int(n.removeprefix("refresh=")) for n in folder.names() if n.startswith("refresh=") and not n.endswith(".done"))
        return sorted((n for n in numbers if folder.exists(f"refresh={n}.done")), reverse=True)

    def _point(self, spark: SparkSession, number: int) -> None:
        spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM parquet.`{self.path}/refresh={number}`")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The view; a catalog that does not know it yet gets it from the newest whole result. None before the first one."""
        if not spark.catalog.tableExists(self.name):
            numbers = self._folders(spark)
            if not numbers:
                return None
            self._point(spark, numbers[0])
        return spark.table(self.name)

    def refresh(self, df: DataFrame, keep: int = 2) -> None:
        """Replace the result; of older ones, ``keep`` stay for readers that have begun."""
        spark, folder = df.sparkSession, Folder(df.sparkSession, self.path)
        used = [int(n.removeprefix("refresh=").removesuffix(".done")) for n in folder.names() if n.startswith("refresh=")]
        number = max(used, default=-1) + 1
        if self.cluster_by:
            write_clustered(df, f"{self.path}/refresh={number}", self.cluster_by)
        else:
            df.write.parquet(f"{self.path}/refresh={number}")
        folder.put(f"refresh={number}.done", number)
        self._point(spark, number)
        for old in self._folders(spark)[1 + keep :]:
            folder.delete(f"refresh={old}.done")
            folder.delete(f"refresh={old}")
