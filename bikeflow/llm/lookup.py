"""Tables of numbers by 64-bit key that tasks build and workers map: their size follows the number of keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bikeflow.llm import textbytes as tb
from bikeflow.llm.tables import mapped, shared_place
from bikeflow.session import work_folder

PART_KEYS = 1 << 22


def _hashed(keys: np.ndarray) -> np.ndarray:
    return tb.mix(keys + np.uint64(0x9E3779B97F4A7C15))


def placed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing at half load: the first free place from a key's own on. Free ones hold NaN."""
    size = 1 << max(1, int(2 * len(keys) - 1).bit_length())
    held, found = np.zeros(size, np.uint64), np.full(size, np.nan)
    spot, left = (_hashed(keys) & np.uint64(size - 1)).astype(np.int64), np.arange(len(keys))
    while len(left):
        at = spot[left]
        free = np.isnan(found[at])
        _, first = np.unique(at[free], return_index=True)
        won = left[free][first]
        held[spot[won]], found[spot[won]] = keys[won], values[won]
        left = np.setdiff1d(left, won, assume_unique=True)
        # Those that found their place taken, now or before, move on.
        spot[left] = (spot[left] + 1) & (size - 1)
    return held, found


class SharedTable:
    """Values by key. A key that the table does not hold is told from all that it holds.

    Parts of bounded size, by the key's hash, are built in tasks of their own from a frame (key long, value double, keys
    distinct, values finite) and lie in shared files, which the workers of a machine map together.
    """

    def __init__(self, frame: DataFrame, name: str, part_keys: int = PART_KEYS):
        spark = frame.sparkSession
        self.folder = work_folder(spark, name)
        system, path = shared_place(self.folder)
        system.create_dir(path, recursive=True)
        count = frame.count()
        self.bits = (max(1, -(-count // part_keys)) - 1).bit_length()
        folder, bits = self.folder, self.bits

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, list] = {}
            for batch in batches:
                keys = batch.column("key").to_numpy().view(np.uint64)
                own = _part(keys, bits)
                for p in np.unique(own).tolist():
                    parts.setdefault(p, []).append((keys[own == p], batch.column("value").to_numpy()[own == p]))
            for p, held in parts.items():
                keys, values = placed(*(np.concatenate(x) for x in zip(*held)))
                here, at = shared_place(folder)
                file = f"{p}-{uuid.uuid4().hex}"
                for end, numbers in (("keys", keys), ("values", values)):
                    with here.open_output_stream(f"{at}/{file}.{end}") as out:
                        out.write(numbers.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([file])], ["part", "file"])

        rows = frame.select("key", "value").mapInArrow(lambda it: _numbered(it, bits), "key long, value double, part int")
        built = rows.repartition(1 << bits, "part").select("key", "value").mapInArrow(build, "part int, file string").collect()
        self.files = {r["part"]: r["file"] for r in built}

    def __getstate__(self) -> dict:
        return {"folder": self.folder, "bits": self.bits, "files": self.files}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        system, path = shared_place(self.folder)
        self.parts = {
            p: (mapped(system, f"{path}/{f}.keys", "<u8"), mapped(system, f"{path}/{f}.values", "<f8")) for p, f in self.files.items()
        }

    def opened(self) -> SharedTable:
        """Ready for look-ups in this process, as it arrives in tasks."""
        table = SharedTable.__new__(SharedTable)
        table.__setstate__(self.__getstate__())
        return table

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of some keys, NaN where there is none."""
        found = np.full(len(keys), np.nan)
        own = _part(keys, self.bits) if self.bits else None
        for p, (held, values) in self.parts.items():
            left = np.arange(len(keys)) if own is None else np.flatnonzero(own == p)
            size = len(held)
            spot = (_hashed(keys[left]) & np.uint64(size - 1)).astype(np.int64)
            while len(left):
                value = values[spot]
                same = held[spot] == keys[left]
                hit = same & ~np.isnan(value)
                found[left[hit]] = value[hit]
                going = ~(same | np.isnan(value))
                left, spot = left[going], (spot[going] + 1) & (size - 1)
        return found


def _part(keys: np.ndarray, bits: int) -> np.ndarray:
    """Leading bits of the hash; a place within a part comes from the last ones."""
    return (_hashed(keys) >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(keys), np.int32)


def _numbered(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part = _part(batch.column("key").to_numpy().view(np.uint64), bits)
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("value"), pa.array(part)], ["key", "value", "part"])
