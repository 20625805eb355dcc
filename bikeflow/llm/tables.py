"""Reading the given tables and landing intermediate results in the shared folder."""

from __future__ import annotations

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.session import work_folder

# Rows of ids that may be broadcast: about 16 MB of values.
BROADCAST_ROWS = 1_000_000


# Rows and bytes of texts that go to a Python worker at once. Spark's default of 10,000 rows lets a task hold
# 10,000 whole texts on both sides of the pipe; a text longer than the bytes is a batch of its own. Results do
# not depend on either.
BATCH_ROWS = 1_000
BATCH_BYTES = 2 << 20
_BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
    "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
}
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_batches(docs: DataFrame) -> SparkSession:
    """The frame's session, with batches small enough for whole texts.

    Plans read the settings when they run, so they stay set; smaller ones of the caller's are left.
    """
    spark = docs.sparkSession
    for name, most in _BATCH_SETTINGS.items():
        if not 0 < int(spark.conf.get(name).rstrip("b")) <= most:
            spark.conf.set(name, str(most))
    return spark


def shared_place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the path in it, for files that tasks write or open themselves."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def mapped(system: fs.FileSystem, path: str, kind) -> np.ndarray:
    """The numbers of a file, mapped where it lies on a mounted disk, else fetched."""
    if isinstance(system, fs.LocalFileSystem):
        size = system.get_file_info(path).size
        return np.memmap(path, kind, "r") if size else np.zeros(0, kind)
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


class SharedArray:
    """Numbers in a shared file, which the workers of a machine map together instead of holding a copy each."""

    def __init__(self, spark: SparkSession, numbers: np.ndarray, name: str):
        self.folder, self.kind = work_folder(spark, name), numbers.dtype.str
        system, path = shared_place(self.folder)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/numbers") as out:
            out.write(np.ascontiguousarray(numbers).tobytes())

    def open(self) -> np.ndarray:
        system, path = shared_place(self.folder)
        return mapped(system, f"{path}/numbers", self.kind)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _written(spark: SparkSession, frame: DataFrame, folder: str) -> DataFrame:
    """Write a frame and read it back; the files of the write's shuffles go as it ends.

    Left to Spark they stay until the driver collects garbage, which it does by its own heap and not by
    the executors' disks: the shuffles of several steps then lie side by side.
    """
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        frame.write.parquet(folder)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(frame.schema).parquet(folder)


def landed(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to a fresh shared folder and read it back: this cuts its lineage.

    An executor that is lost afterwards costs nothing, as the files are shared.
    """
    return _written(spark, frame, work_folder(spark, name))


class Workspace:
    """A fresh shared folder for the intermediate tables of one operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.count = spark, work_folder(spark, name), 0
        self.held: dict[str, list[str]] = {}

    def land(self, frame: DataFrame, name: str) -> DataFrame:
        self.count += 1
        folder = f"{self.folder}/{name}-{self.count}"
        found = _written(self.spark, frame, folder)
        self.held.setdefault(name, []).append(folder)
        return found

    def drop(self, *names: str) -> None:
        """Delete tables that no later result reads."""
        for folder in (f for name in names for f in self.held.pop(name, [])):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The text and, as one column ``row``, all others: added columns then clash with none of them."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select((F.struct(*rest) if rest else F.lit(None).cast("int")).alias("row"), F.col(f"`{text}`").alias("text"))


def unpacked(rows: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The columns that ``packed`` folded, in their order."""
    return rows.select(*[F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns])


def small_side(frame: DataFrame, rows: int) -> DataFrame:
    """Broadcast a key table of known size while it is below the bound, else shuffle it.

    ``rows`` is the measured count, not an estimate. Beyond the bound the larger side is
    streamed past a hash table of its shuffle partition's keys.
    """
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame.hint("shuffle_hash")


def in_fold(doc_id, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves this remainder; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
