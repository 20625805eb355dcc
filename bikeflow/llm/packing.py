"""Hierarchical packing of documents into training sequences.

Each task packs the documents it reads, so nothing is shuffled and a lost task is simply run again
with the same result. Tokens wait in a bounded pool. From the pool

* whole long windows are cut from documents that fill them;
* the rest of each document is routed to a tier by its length, the smallest window that holds it;
* each tier, from the shortest, packs windows of its own size, pieces of its own first; what shorter tiers
  keep back fills the gaps, best fit first, and a gap that nothing fits takes the head of the shortest waiting
  piece, whose tail waits on in the tier of its length;
* when the input ends, what is less than a window in every tier fills windows together;
  at most one window per task, of fewer tokens than the smallest tier, is padded.

A training step takes sequences of one size: those of each size are dealt to step groups of equal number such that the
groups' attention cost (sum of squared piece lengths) is about the same.

Defined cases: a null text is empty, and a document without tokens is the end token alone; equal
ids and repeated rows are packed one by one; an empty table gives no sequence; texts of any length
are cut into windows.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from bikeflow.llm.tables import table, text_batches
from bikeflow.llm.token_counts import tokenizer_path

MODEL = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
END_TOKEN = 1
WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
STEP_GROUP = 8
POOL_TOKENS = 1_000_000
ID_BYTES = 4

# The published pattern of the vocabulary's words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Outside these, the libraries' character classes may differ.
PLAIN = re.compile("[\t\n\r -~¡-ɏ]*")

SCHEMA = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long, tier int, step_group long"
)
COLUMNS = [x.split()[0] for x in SCHEMA.split(", ")]


class Ids:
    """Texts to ids as little-endian 32-bit numbers.

    With the vocabulary's rank file, texts of plain characters without special strings are encoded by
    ``tiktoken``, several times faster and with the same ids; all others by ``tokenizers``.
    """

    def __init__(self, path: str, ranks: str | None = None):
        self.path, self.plain = path, None
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                held = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
            self.plain = tiktoken.Encoding("plain", pat_str=WORDS, mergeable_ranks=held, special_tokens={})

    @cached_property
    def model(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, text: str) -> bytes:
        if self.plain and PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            ids = self.plain.encode_ordinary(text)
        else:
            ids = self.model.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


class Packer:
    """Packs pieces (row, start, ids, tokens of the document) into sequences."""

    def __init__(self, window: int, tiers: tuple[int, ...]):
        self.window, self.tiers = window, sorted(tiers)
        # Per tier, waiting pieces in order of length; the second number only breaks ties.
        self.waiting: list[list] = [[] for _ in self.tiers]
        self.held = [0] * len(self.tiers)  # tokens that wait in each
        self.taken = 0

    @property
    def tokens(self) -> int:
        return sum(self.held)

    def _route(self, row, start: int, ids: bytes, total: int) -> None:
        n = len(ids) // ID_BYTES
        self.taken += 1
        tier = bisect.bisect_left(self.tiers, n)
        bisect.insort(self.waiting[tier], (n, self.taken, row, start, ids, total), key=lambda p: p[:2])
        self.held[tier] += n

    def add(self, row, ids: bytes) -> Iterator[list]:
        total, step = len(ids) // ID_BYTES, self.window * ID_BYTES
        whole = total // self.window
        for k in range(whole):
            yield [(row, k * self.window, ids[k * step : (k + 1) * step], total)]
        if total % self.window:
            self._route(row, whole * self.window, ids[whole * step :], total)

    def _pop(self, tier: int, k: int) -> tuple:
        piece = self.waiting[tier].pop(k)
        self.held[tier] -= piece[0]
        return piece

    def _take(self, room: int, top: int) -> tuple:
        """The longest waiting piece that fits, from tier ``top`` down, or else the head of the shortest one of any tier."""
        for tier in reversed(range(top + 1)):
            k = bisect.bisect_right(self.waiting[tier], room, key=lambda p: p[0])
            if k:
                return self._pop(tier, k - 1)[2:]
        tier = next(t for t, pieces in enumerate(self.waiting) if pieces)
        _, _, row, start, ids, total = self._pop(tier, 0)
        self._route(row, start + room, ids[room * ID_BYTES :], total)
        return row, start, ids[: room * ID_BYTES], total

    def fill(self, size: int, top: int) -> list:
        """One full sequence of ``size`` tokens: pieces of tier ``top`` first, its gap from shorter ones."""
        sequence, room = [], size
        while room:
            piece = self._take(room, top)
            sequence.append(piece)
            room -= len(piece[2]) // ID_BYTES
        return sequence

    def drain(self, keep: int) -> Iterator[list]:
        """Each tier packs windows of its own size until it holds no more than its share of ``keep``.

        Shares are as the windows' sizes. Shorter tiers go first, so that only what they keep fills the gaps of longer ones.
        """
        for top, size in enumerate(self.tiers):
            while self.held[top] >= max(size, keep * size // sum(self.tiers)):
                yield self.fill(size, top)

    def close(self) -> Iterator[list]:
        yield from self.drain(0)
        # Less than a window is left in every tier: together they fill some more.
        for size in reversed(self.tiers):
            while self.tokens >= size:
                yield self.fill(size, len(self.tiers) - 1)
        if self.tokens:
            yield self.fill(self.tokens, len(self.tiers) - 1)


def _grouped(sequences: list[list], first: int, prefix: int, group: int) -> Iterator[tuple]:
    """Rows of sequences; the costliest go to step groups in turn, there and back."""
    groups = max(1, len(sequences) // group)
    cost = [sum((len(p[2]) // ID_BYTES) ** 2 for p in s) for s in sequences]
    dealt = [0] * len(sequences)
    for k, i in enumerate(sorted(range(len(sequences)), key=lambda i: -cost[i])):
        turn, place = divmod(k, groups)
        dealt[i] = place if turn % 2 == 0 else groups - 1 - place
    for i, sequence in enumerate(sequences):
        tokens = sum(len(p[2]) for p in sequence) // ID_BYTES
        offset = 0
        for row, start, ids, total in sequence:
            n = len(ids) // ID_BYTES
            yield row, start, n, zlib.crc32(ids), total, prefix + first + i, offset, tokens, prefix + first + dealt[i]
            offset += n


def _pack(batches, text: str, path: str, ranks, window: int, tiers, group: int, pool: int):
    ids, packer = Ids(path, ranks), Packer(window, tiers)
    prefix = TaskContext.get().partitionId() << 40
    end = END_TOKEN.to_bytes(ID_BYTES, "little")
    # Sequences that wait for their step groups, by the size of their window.
    ready, count, schema = {}, 0, None

    def rows(sequences, first):
        found = list(_grouped(sequences, first, prefix, group))
        kept = pa.Table.from_pylist([r[0] for r in found], schema=schema)
        tokens = [r[7] for r in found]
        values = [list(c) for c in zip(*(r[1:] for r in found))]
        size = [next((t for t in tiers if t >= n), window) for n in tokens]
        values = [*values[:7], size, values[7]]
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        arrays = [c.combine_chunks() for c in kept.columns] + [pa.array(v, k) for v, k in zip(values, kinds)]
        return pa.RecordBatch.from_arrays(arrays, [*schema.names, *COLUMNS])

    def kept(sequences):
        for sequence in sequences:
            n = sum(len(p[2]) for p in sequence) // ID_BYTES
            ready.setdefault(next((t for t in packer.tiers if t >= n), window), []).append(sequence)

    for batch in batches:
        keys = batch.drop_columns([text])
        schema = keys.schema
        for key, text_now in zip(keys.to_pylist(), batch.column(text)):
            kept(packer.add(key, ids.encode(text_now.as_py() or "") + end))
            if packer.tokens > pool:
                kept(packer.drain(pool // 2))
            for size, sequences in ready.items():
                whole = len(sequences) - len(sequences) % group
                if whole >= 16 * group:
                    yield rows(sequences[:whole], count)
                    count, ready[size] = count + whole, sequences[whole:]
    kept(packer.close())
    for _, sequences in sorted(ready.items()):
        if sequences:
            yield rows(sequences, count)
            count += len(sequences)


def pack(
    docs: DataFrame,
    *,
    keys: list[str],
    model: str,
    ranks: str | None = None,
    text: str = "text",
    window: int = WINDOW,
    tiers: tuple[int, ...] = TIERS,
    step_group: int = STEP_GROUP,
    pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """One row per piece: ``keys``, its place in the document and in its sequence, crc32 of its ids."""
    text_batches(docs)
    docs = docs.select(*keys, text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)
    packed = docs.mapInArrow(lambda it: _pack(it, text, model, ranks, window, tiers, step_group, pool_tokens), f"{kinds}, {SCHEMA}")
    return packed


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return pack(docs, keys=["doc_id"], model=tokenizer_path(MODEL), ranks=tokenizer_path(RANKS))
