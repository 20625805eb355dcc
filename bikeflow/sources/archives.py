"""CSV members of zip archives, member by member.

An archive ends with a directory of its members. One pass over the archives reads these directories and nothing else;
the members are then dealt out, and each is unpacked as a stream by a task of its own, which seeks to it in the archive. So
neither the size nor the number of archives bounds how many tasks work, and no archive is held in memory. Python splits a member's
lines into records only; Spark parses them.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikeflow.sources.places import open_place

RECORDS_PER_BATCH = 10_000
MOST_TASKS = 10_000

_MEMBERS = "archive string, member string, packed long, size long, taken boolean, names array<string>"
_RECORDS = "archive string, member string, names array<string>, record string"


def read_archives(spark: SparkSession, folder: str, glob: str = "*.zip") -> DataFrame:
    """``path`` and ``length`` of the archives of a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "length")


class _Seekable(io.RawIOBase):
    """A file of any file system as ``zipfile`` wants it: seeking before its start is an OSError."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.file.tell(), io.SEEK_END: self.size}[whence]
        if place < 0:
            raise OSError("before the start of the file")
        self.file.seek(place)
        return place

    def readinto(self, buffer) -> int:
        found = self.file.read(len(buffer))
        buffer[: len(found)] = found
        return len(found)

    def close(self) -> None:
        self.file.close()
        super().close()


def _opened(path: str) -> zipfile.ZipFile:
    system, place = open_place(path)
    return zipfile.ZipFile(io.BufferedReader(_Seekable(system.open_input_file(place)), 1 << 16))


def _texts(archive: zipfile.ZipFile, member: str) -> io.TextIOWrapper:
    return io.TextIOWrapper(archive.open(member), "utf-8-sig", newline="")


def records(lines: Iterator[str]) -> Iterator[str]:
    """Lines put together where a quoted value goes on in the next one; empty ones are left out."""
    held = ""
    for line in lines:
        held += line
        if held.count('"') % 2 == 0:
            if held := held.rstrip("\r\n"):
                yield held
            held = ""
    if held := held.rstrip("\r\n"):
        yield held


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _MEMBERS.split(", ")]
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows = []
            with _opened(path) as archive:
                for info in archive.infolist():
                    taken = info.filename.lower().endswith(".csv")
                    header = None
                    if taken:
                        with _texts(archive, info.filename) as lines:
                            header = next(csv.reader([next(records(lines), "")]), [])
                    if not info.is_dir():
                        rows.append((path, info.filename, info.compress_size, info.file_size, taken, header))
            columns = list(zip(*rows)) or [[]] * len(names)
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def archive_members(archives: DataFrame) -> DataFrame:
    """The members of archives (column ``path``), with sizes, whether they are CSV (``taken``), and their header's names."""
    return archives.select("path").mapInArrow(_listed, _MEMBERS)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
    for batch in batches:
        for path, member, header in zip(*(batch.column(c).to_pylist() for c in ("archive", "member", "names"))):
            with _opened(path) as archive, _texts(archive, member) as lines:
                found = records(lines)
                next(found, None)
                while held := list(islice(found, RECORDS_PER_BATCH)):
                    values = [[path] * len(held), [member] * len(held), [header] * len(held), held]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["archive", "member", "names", "record"])


def zipped_csv_rows(archives: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Rows of all CSV members of zip archives (column ``path``), with ``archive`` and ``member``.

    Columns are matched by the member's header; '' is NULL, and so are text that does not fit its type and
    columns that a member or a record does not have.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    members = archive_members(archives).filter("taken")
    count, widest = members.agg(F.count("*"), F.max(F.size("names"))).first()
    dealt = members.select("archive", "member", "names").repartition(max(1, min(count, MOST_TASKS)))
    parts = dealt.mapInArrow(_unpacked, _RECORDS)
    width = max(1, widest or 0)
    shape = ", ".join(f"c{k} string" for k in range(width))
    # An unclosed quote must not spoil what follows it, so records are parsed one by one.
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1", "maxColumns": str(width + 1024)}
    values = F.from_csv("record", F.lit(shape), options)
    parsed = parts.select("archive", "member", "names", values.alias("v"))
    held = F.array(*[F.col(f"v.c{k}") for k in range(width)])

    def column(field: T.StructField):
        text = F.get(held, F.array_position("names", field.name).cast("int") - 1)
        return F.nullif(text, F.lit("")).try_cast(field.dataType).alias(field.name)

    return parsed.select("archive", "member", *map(column, wanted.fields))
