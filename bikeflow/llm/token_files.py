"""Token ids as flat binary files with 64-bit document offsets.

A corpus is a folder of shards in the order of the document ids. A shard is three files of little-endian numbers:

* ``.ids``      the ids of its documents one behind the other, 16 bits each if the vocabulary allows, else 32;
* ``.offsets``  a 64-bit unsigned number per document and one more: where its ids begin in ``.ids``, in ids;
* ``.keys``     a 64-bit signed document id per document; those without one come first and are counted.

Documents are dealt out by ranges of their ids, each task sorts and encodes its range and writes shards of bounded
size, and returns a row per shard. These rows, a few numbers each, are the manifest: prefix sums over them
give every shard its place among all documents and all ids, so tasks need not know of one another. The
manifest lands last and names the files that count, so what a lost or repeated task has left behind is never read.
Reading maps the files of a shard into memory and touches only the pages that a document's ids lie in.

Defined cases: a null text is empty, its document the end id alone; null ids come first; rows with equal ids
stand side by side, in the order of a hash of their texts, and copies of a text in any order, as they cannot be told apart; ids that a third of
the rows share are dealt out over several ranges; an empty table gives no shard; other columns are not read.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm.tables import mapped, shared_place, table, text_batches
from bikeflow.llm.token_counts import tokenizer_path
from bikeflow.session import work_folder

MODEL = "word_bpe_49k.json"
END_TOKEN = 1
SHARD_TOKENS = 1 << 26

# How vocabularies of this kind normalise texts and cut them into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_END = "</w>"

# In these characters every text is in normal form, and the classes below are those of the pattern above.
PLAIN = re.compile("[\t\n\r -~¡-ɏ]*")
LETTERS, NUMBERS = "a-zªµºß-öø-ɏⱥⱦ", "0-9²³¹¼-¾"
# The pattern's alternatives; which comes first matters for those with an apostrophe only.
PLAIN_WORDS = re.compile(rf"[{LETTERS}]+|[{NUMBERS}]|'(?:[stmd]|re|ve|ll)|[^\s{LETTERS}{NUMBERS}]+")
MARK = "\x01"  # stands for the end of a word; no plain text has it

MANIFEST = "task int, shard int, name string, docs long, unnamed long, tokens long"


def _bytes_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, then the others in turn."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Texts to the bytes of their ids, the end id behind them.

    Plain texts without special strings are cut into words, each with a mark at its end, and encoded by ``tiktoken``, whose
    ranks are the same vocabulary with the mark in place of its word end: several times faster, in one thread, with the same
    ids. All other texts are encoded by ``tokenizers``, and so are all with a vocabulary of another kind.
    """

    def __init__(self, path: str, end: int | None = END_TOKEN):
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        self.path, self.kind = path, id_kind(path)
        self.end = b"" if end is None else np.array([end], self.kind).tobytes()
        self.special = [t["content"] for t in described["added_tokens"]]
        self.plain = self._ranked(described["model"]["vocab"]) if self._known(described) else None

    @staticmethod
    def _known(described: dict) -> bool:
        before = (described.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split = {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
        return (
            (described.get("normalizer") or {}).get("normalizers") == NORMALIZERS
            and before[0] == split
            and [p["type"] for p in before[1:]] == ["ByteLevel"]
            and not before[1]["use_regex"]
            and not before[1]["add_prefix_space"]
            and described["model"].get("end_of_word_suffix") == WORD_END
        )

    @staticmethod
    def _ranked(vocabulary: dict[str, int]):
        import tiktoken

        of, ranks = _bytes_of(), {}
        for word, rank in vocabulary.items():
            ends = word.endswith(WORD_END) and word != WORD_END
            raw = bytes(of[c] for c in (word.removesuffix(WORD_END) if ends else word))
            ranks[raw + MARK.encode() if ends else raw] = rank
        return tiktoken.Encoding("words", pat_str=f"[^{MARK}]*{MARK}", mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def model(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, text: str) -> bytes:
        if self.plain and PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            words = PLAIN_WORDS.findall(text.lower())
            ids = self.plain.encode_ordinary(MARK.join([*words, ""]))
        else:
            ids = self.model.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.kind).tobytes() + self.end


def id_kind(path: str) -> np.dtype:
    """The width of ids, from the largest id of a vocabulary file."""
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    most = max([*described["model"]["vocab"].values(), *(t["id"] for t in described["added_tokens"])])
    return np.dtype("<u2" if most < 1 << 16 else "<u4")


class _Shard:
    """Files of one shard while they are written, under a name of this attempt's own."""

    def __init__(self, folder: str, task: int, number: int):
        self.name = f"{task:06d}-{number:04d}-{uuid.uuid4().hex}"
        self.task, self.number = task, number
        self.system, path = shared_place(folder)
        self.path = f"{path}/{self.name}"
        self.out = self.system.open_output_stream(f"{self.path}.ids")
        self.offsets, self.keys, self.unnamed, self.tokens = [0], [], 0, 0

    def add(self, key: int | None, ids: bytes, width: int) -> None:
        self.out.write(ids)
        self.tokens += len(ids) // width
        self.offsets.append(self.tokens)
        self.unnamed += key is None
        self.keys.append(key or 0)

    def close(self) -> pa.RecordBatch:
        self.out.close()
        for end, numbers, kind in (("offsets", self.offsets, "<u8"), ("keys", self.keys, "<i8")):
            with self.system.open_output_stream(f"{self.path}.{end}") as out:
                out.write(np.array(numbers, kind).tobytes())
        values = [self.task, self.number, self.name, len(self.keys), self.unnamed, self.tokens]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], _names(MANIFEST))


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _write(batches: Iterator[pa.RecordBatch], folder: str, model: str, end: int | None, most: int):
    encoder, shard, number = Encoder(model, end), None, 0
    task, width = TaskContext.get().partitionId(), encoder.kind.itemsize
    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
            if shard is None:
                shard, number = _Shard(folder, task, number), number + 1
            shard.add(key, encoder.encode(text.as_py() or ""), width)
            if shard.tokens >= most:
                yield shard.close()
                shard = None
    if shard is not None:
        yield shard.close()


@dataclass
class TokenFiles:
    """A written corpus: its folder, the width of ids, and the manifest with each shard's bases."""

    folder: str
    kind: str
    manifest: DataFrame  # task, shard, name, docs, unnamed, tokens, first_doc, first_token, in order

    def documents(self, with_ids: bool = False) -> DataFrame:
        """doc_id, start, n_tokens and ids_crc32 (of the ids as 32-bit numbers) of each document, and its ids if wanted."""
        shards = self.manifest.agg(F.count("*")).first()[0]
        rows = self.manifest.repartition(max(1, shards))
        schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
        folder, kind = self.folder, self.kind
        return rows.mapInArrow(lambda it: _read(it, folder, kind, with_ids), schema)


class Shard:
    """One shard, opened for reading."""

    def __init__(self, folder: str, name: str, kind: str, unnamed: int = 0):
        system, path = shared_place(folder)
        self.ids, self.offsets, self.keys = (mapped(system, f"{path}/{name}.{end}", k) for end, k in (("ids", kind), ("offsets", "<u8"), ("keys", "<i8")))
        self.unnamed = unnamed

    def __len__(self) -> int:
        return len(self.keys)

    def __getitem__(self, place: int) -> np.ndarray:
        """The ids of the document at a place."""
        return self.ids[int(self.offsets[place]) : int(self.offsets[place + 1])]


_READ_ROWS = 5_000


def _read(batches: Iterator[pa.RecordBatch], folder: str, kind: str, with_ids: bool):
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(folder, row["name"], kind, row["unnamed"])
            if len(shard) != row["docs"] or len(shard.ids) != row["tokens"] or len(shard.offsets) != row["docs"] + 1:
                raise OSError(f"shard {row['name']} does not have the size that the manifest names")
            for first in range(0, len(shard), _READ_ROWS):
                places = range(first, min(first + _READ_ROWS, len(shard)))
                starts = np.array(shard.offsets[first : places.stop + 1], np.int64)
                documents = [shard[k].astype("<u4") for k in places]
                arrays = [
                    pa.array(np.array(shard.keys[first : places.stop]), mask=np.arange(first, places.stop) < shard.unnamed),
                    pa.array(starts[:-1] + row["first_token"]),
                    pa.array(np.diff(starts)),
                    pa.array([zlib.crc32(d.tobytes()) for d in documents], pa.int64()),
                ]
                if with_ids:
                    arrays.append(pa.array([d.view(np.int32) for d in documents], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(arrays)])


def write_tokens(
    docs: DataFrame,
    folder: str,
    *,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    end: int | None = END_TOKEN,
    shard_tokens: int = SHARD_TOKENS,
) -> TokenFiles:
    """Encode ``docs`` into a fresh folder that all executors reach. ``shard_tokens`` bounds a file, not the result."""
    spark = text_batches(docs)
    system, path = shared_place(folder)
    system.create_dir(path, recursive=True)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "turn": F.monotonically_increasing_id()})
    order = ["key", "tie", "turn"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    written = rows.mapInArrow(lambda it: _write(it, folder, model, end, shard_tokens), MANIFEST)
    written.write.parquet(f"{folder}/written")

    # A row per file: places come from sums over the files before.
    shards = sorted(spark.read.schema(MANIFEST).parquet(f"{folder}/written").collect(), key=lambda r: (r.task, r.shard))
    docs_before, tokens_before = (np.cumsum([0, *(r[c] for r in shards)]).tolist() for c in ("docs", "tokens"))
    placed = [(*r, d, t) for r, d, t in zip(shards, docs_before, tokens_before)]
    manifest = spark.createDataFrame(placed, f"{MANIFEST}, first_doc long, first_token long")
    manifest.write.parquet(f"{folder}/manifest")
    return open_tokens(spark, folder, id_kind(model).str)


def open_tokens(spark: SparkSession, folder: str, kind: str) -> TokenFiles:
    """A corpus written before."""
    manifest = spark.read.schema(f"{MANIFEST}, first_doc long, first_token long").parquet(f"{folder}/manifest")
    return TokenFiles(folder, kind, manifest)


def op12_token_binary(spark: SparkSession, sf: str) -> DataFrame:
    files = write_tokens(table(spark, sf, "documents"), work_folder(spark, "token-files"), model=tokenizer_path(MODEL))
    return files.documents()
