"""Batch readers: files and folders as relations, listings, names of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikeflow.functions import text

def query_path(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """A file or a folder addressed in SQL: ``kind`` is json, text, parquet, csv, ..."""
    return spark.sql(f"SELECT * FROM {kind}.`{path}`")


def read_json(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON documents. Without a schema Spark reads the data twice, the first time to infer it."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def sample_schema(spark: SparkSession, sample_file: str, field: str, multi_line: bool = False) -> T.StructType:
    """Schema of one nested field, inferred from a file of samples, or from all files of a folder."""
    return read_json(spark, sample_file, multi_line=multi_line).select(field).schema


def read_text(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One row per line, or per file when ``whole_files`` (pretty-printed documents)."""
    return spark.read.text(path, wholetext=whole_files)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column is a string."""
    return spark.read.csv(path, header=True)


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, sampling: float = 1.0
) -> DataFrame:
    """CSV with a header and typed columns.

    Without a schema the types are inferred in an extra pass over ``sampling`` of the rows.
    """
    if schema:
        return spark.read.schema(schema).csv(path, header=True)
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a temporary view and hand the frame on."""
    df.createOrReplaceTempView(name)
    return df


def list_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Path, size and modification time of the files of a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return reader.load(folder).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modification_time"),
    )


def with_capture_columns(df: DataFrame) -> DataFrame:
    """Capture time and run id out of the landing name in each row's file path."""
    path = F.col("_metadata.file_path")
    return df.select(
        "*", text.capture_time(path).alias("capture_time"), text.capture_run(path).alias("run_id")
    )
