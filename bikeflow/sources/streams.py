"""Streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bikeflow import schemas


def stream_documents(
    spark: SparkSession,
    folder: str,
    glob: str = "*.json",
    station: str | None = None,
    max_files: int | None = None,
    multi_line: bool = False,
    broken: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Feed documents as they land; each file is taken up once per checkpoint.

    With the type of a ``station`` the nested object is parsed by the reader itself, in one
    pass; else it arrives as text. The other fields are text in both cases. A column named by
    ``broken`` gets the text of documents that do not parse or hold values of other types.
    Files that are done move to the ``archive`` folder, if any, so that the landing folder stays
    short to list.
    """
    schema = schemas.parsed_document(station) if station else schemas.RAW_DOCUMENT
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if broken:
        schema = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    reader = (
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", broken or "_corrupt_record")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("multiLine", multi_line)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(folder)


def stream_folder(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    glob: str = "*.parquet",
    max_files: int | None = None,
) -> DataFrame:
    """An append-only Parquet folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table as a stream."""
    return spark.readStream.table(name)
