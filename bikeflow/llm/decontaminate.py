"""Benchmark decontamination by Wu-Manber search over words.

The symbols are words, the patterns all windows of 13 words of the benchmark items (an item of
fewer words is one pattern). For each pattern length there is a shift table over hashed blocks of
two words and a bucket of patterns per hashed suffix block. Documents are scanned with one cursor
per stride: a cursor that stands on a block which no pattern holds skips the whole stride; where the
shift is zero the suffix bucket gives the patterns, and their words are compared one by one.

Documents are not shuffled, and neither side passes through the driver. A task builds a set of patterns of bounded size
(``max_pattern_words``) from the items that fall to it by hash and writes its tables as flat files into the shared folder. Every
scanning task maps the files of one set behind the other over a group of texts: the workers of a machine share
the mapped pages, so a further set costs its look-ups and no loading. The hits of all sets meet in the row's own
task, and rows are never regrouped by key.

Defined cases: null texts and texts without words have no words, no hits and are not contaminated; null items and
items without words are no patterns; an item without an id is a pattern like any other, but has no id to report; items with equal
text are all reported; equal item ids count once; documents with equal ids are counted apart.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm import textbytes as tb
from bikeflow.llm.tables import mapped, packed, shared_place, table, text_batches, unpacked
from bikeflow.session import work_folder

WINDOW = 13
CONTAMINATED_SHARE = 20  # n_hit * share >= n_words
MAX_PATTERN_WORDS = 200_000
GROUP_BYTES = 8 << 20  # of texts that are held while several pattern sets pass

WORD_BYTES = tb.byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_TABLE_BITS = 20
_BLOCK = 2
_SCAN = "n_words long, n_hit long, items array<string>"
_SET = "name string, lengths array<int>, blocks array<int>"


def _words(text: str) -> list[bytes]:
    data = tb.LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = tb.word_bounds(data, np.array([0, len(data)]), WORD_BYTES)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts, ends)]


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings one behind the other, and where each begins and the last one ends."""
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)], dtype=np.int64)


@dataclass
class Table:
    """The patterns of one length: shift table, suffix buckets, and what confirms and names a pattern."""

    block: int
    shift: np.ndarray
    suffix: np.ndarray  # keys of the patterns' last blocks, sorted
    order: np.ndarray  # the patterns in that order
    hashes: np.ndarray  # of each pattern's first word
    words: np.ndarray
    starts: np.ndarray
    owners: np.ndarray  # numbers of the items with a pattern, pattern by pattern
    owned: np.ndarray

    def spelled(self, pattern: int) -> bytes:
        return self.words[self.starts[pattern] : self.starts[pattern + 1]].tobytes()

    def items(self, pattern: int) -> list[int]:
        return self.owners[self.owned[pattern] : self.owned[pattern + 1]].tolist()


_KINDS = {"shift": "u1", "suffix": "<i8", "order": "<i8", "hashes": "<u8", "words": "u1", "starts": "<i8", "owners": "<i8", "owned": "<i8"}


class Patterns:
    """The windows of some items, a table per window length."""

    def __init__(self, tables: dict[int, Table], names: np.ndarray, bounds: np.ndarray):
        """``names``: the items' ids one behind the other, an empty one for none."""
        self.tables, self.names, self.bounds = tables, names, bounds

    @classmethod
    def of(cls, items: list[tuple[str | None, str]], window: int) -> Patterns:
        held: dict[int, dict[bytes, set[int]]] = {}
        for number, (_, text) in enumerate(items):
            words = _words(text)
            if words:
                n = min(window, len(words))
                for i in range(len(words) - n + 1):
                    held.setdefault(n, {}).setdefault(b" ".join(words[i : i + n]), set()).add(number)
        names = _flat([b"" if name is None else b"=" + name.encode() for name, _ in items])
        return cls({n: cls._table(n, p) for n, p in held.items()}, *names)

    @staticmethod
    def _table(n: int, held: dict[bytes, set[int]]) -> Table:
        block, patterns = min(_BLOCK, n), sorted(held)
        words, offsets = _flat(patterns)
        starts, ends, _ = tb.word_bounds(words, offsets, WORD_BYTES)
        hashes = tb.span_hashes(words, starts, ends).reshape(len(patterns), n)
        longest = n - block + 1
        shift = np.full(1 << _TABLE_BITS, min(longest, 255), np.uint8)
        for end in range(block, n + 1):
            keys = _keys(hashes[:, end - block : end], block)
            np.minimum.at(shift, keys, np.uint8(min(n - end, 255)))
        suffix = _keys(hashes[:, n - block :], block)
        order = np.argsort(suffix, kind="stable")
        owners = [sorted(held[p]) for p in patterns]
        owned = np.cumsum([0, *map(len, owners)], dtype=np.int64)
        flat = np.array([x for o in owners for x in o], np.int64)
        return Table(block, shift, suffix[order], order, np.ascontiguousarray(hashes[:, 0]), words, offsets, flat, owned)

    def write(self, folder: str) -> dict:
        """Flat files under a name of their own, and the row that names them."""
        name = uuid.uuid4().hex
        system, path = shared_place(folder)

        def put(end: str, numbers: np.ndarray) -> None:
            with system.open_output_stream(f"{path}/{name}.{end}") as out:
                out.write(np.ascontiguousarray(numbers).tobytes())

        put("names", self.names)
        put("bounds", self.bounds)
        for n, held in self.tables.items():
            for part in _KINDS:
                put(f"{n}.{part}", getattr(held, part))
        return {"name": name, "lengths": [*self.tables], "blocks": [t.block for t in self.tables.values()]}

    @classmethod
    def open(cls, folder: str, row: dict) -> Patterns:
        system, path = shared_place(folder)
        get = lambda end, kind: mapped(system, f"{path}/{row['name']}.{end}", kind)
        tables = {
            n: Table(block, **{part: get(f"{n}.{part}", kind) for part, kind in _KINDS.items()})
            for n, block in zip(row["lengths"], row["blocks"])
        }
        return cls(tables, get("names", "u1"), get("bounds", "<i8"))

    def ids(self, numbers: set[int]) -> set[str]:
        """Of the items that have one."""
        spans = (self.names[self.bounds[k] : self.bounds[k + 1]].tobytes() for k in numbers)
        return {raw[1:].decode() for raw in spans if raw}

    def find(self, hashes: np.ndarray, first: int, spell) -> Iterator[tuple[int, int, int]]:
        """(start word, length, pattern) of every occurrence in one run of word hashes."""
        for n, held in self.tables.items():
            block = held.block
            if len(hashes) < n:
                continue
            keys = np.zeros(len(hashes), np.int64)  # of the block that ends at a word
            keys[block - 1 :] = _keys(np.lib.stride_tricks.sliding_window_view(hashes, block), block)
            stride = max(1, n - block + 1)
            at = np.arange(n - 1, len(hashes), stride)
            stop = np.minimum(at + stride, len(hashes))
            while len(at):
                step = held.shift[keys[at]].astype(np.int64)
                for end in at[step == 0].tolist():
                    low, high = np.searchsorted(held.suffix, [keys[end], keys[end] + 1])
                    same = held.order[low:high]
                    same = same[held.hashes[same] == hashes[end - n + 1]]
                    if len(same):
                        text = spell(first + end - n + 1, first + end + 1)
                        for p in same.tolist():
                            if held.spelled(p) == text:
                                yield first + end - n + 1, n, p
                at = at + np.maximum(step, 1)
                live = at < stop
                at, stop = at[live], stop[live]


def _keys(blocks: np.ndarray, block: int) -> np.ndarray:
    h = blocks[:, 0]
    if block == 2:
        h = tb.mix(h * np.uint64(3) + blocks[:, 1])
    return (h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class _Slice:
    """Words of some texts of a batch, and what was found in them."""

    def __init__(self, row: int, past: int, data: np.ndarray, offsets: np.ndarray):
        self.row, self.past, self.data = row, past, tb.LOWER[data]
        self.starts, self.ends, self.before = tb.word_bounds(self.data, offsets, WORD_BYTES)
        self.hashes = tb.span_hashes(self.data, self.starts, self.ends)
        self.hit = np.zeros(len(self.starts) + 1, np.int64)

    def spell(self, a: int, b: int) -> bytes:
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(a, b))

    def search(self, patterns: Patterns, items: list[set]) -> None:
        found: dict[int, set] = {}
        # One run for the whole slice; an occurrence across two texts is none.
        for start, n, p in patterns.find(self.hashes, 0, self.spell):
            doc = int(np.searchsorted(self.before, start, "right")) - 1
            if start + n <= self.before[doc + 1]:
                self.hit[start] += 1
                self.hit[start + n] -= 1
                found.setdefault(self.row + doc, set()).add((n, p))
        for row, seen in found.items():
            items[row].update(patterns.ids({k for n, p in seen for k in patterns.tables[n].items(p)}))


def _groups(batches: Iterator[pa.Array], limit: int) -> Iterator[list[pa.Array]]:
    """Batches of about ``limit`` bytes together."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _scan(batches: Iterator[pa.Array], folder: str, sets: list[dict]) -> Iterator[pa.Array]:
    """Each text against all pattern sets."""
    opened = [Patterns.open(folder, row) for row in sets]  # maps files, reads nothing
    for group in _groups(batches, GROUP_BYTES if len(sets) > 1 else 0):
        cut = [[_Slice(*x) for x in tb.slices(texts)] for texts in group]
        items: list = [[set() for _ in range(len(texts))] for texts in group]
        for patterns in opened:
            for slices, found in zip(cut, items):
                for s in slices:
                    s.search(patterns, found)
        for texts, slices, found in zip(group, cut, items):
            n_words = np.zeros(len(texts), np.int64)
            n_hit = np.zeros(len(texts), np.int64)
            for s in slices:
                n_words[s.row : s.past] = np.diff(s.before)
                covered = np.concatenate([[0], np.cumsum(np.cumsum(s.hit)[:-1] > 0)])
                n_hit[s.row : s.past] = covered[s.before[1:]] - covered[s.before[:-1]]
            columns = [pa.array(n_words), pa.array(n_hit), pa.array([sorted(x) for x in found], pa.list_(pa.string()))]
            yield pa.StructArray.from_arrays(columns, ["n_words", "n_hit", "items"])


def _build(batches: Iterator[pa.RecordBatch], folder: str, window: int) -> Iterator[pa.RecordBatch]:
    """The items of a task, which come sorted by their set, to one set after the other."""
    at, held = None, []
    schema = pa.schema([("name", pa.string()), ("lengths", pa.list_(pa.int32())), ("blocks", pa.list_(pa.int32()))])

    def row():
        return pa.RecordBatch.from_pylist([Patterns.of(held, window).write(folder)], schema)

    for batch in batches:
        for number, item, text in zip(*(batch.column(c).to_pylist() for c in ("set", "item", "item_text"))):
            if number != at and held:
                yield row()
                held = []
            at = number
            held.append((item, text))
    if held:
        yield row()


def pattern_sets(benchmark: DataFrame, folder: str, *, item: str, text: str, window: int, max_words: int) -> list[dict]:
    """Build the sets in tasks of their own; a row per set comes back, the sets stay in the folder."""
    system, path = shared_place(folder)
    system.create_dir(path, recursive=True)
    wanted = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("item_text"))
    wanted = wanted.filter("item_text is not null and item_text != ''")
    size = wanted.agg(F.coalesce(F.sum(F.length("item_text")), F.lit(0))).first()[0]
    sets = max(1, math.ceil(size / (4 * max_words)))
    # Items by id and text, so that a third of them under one id is dealt out all the same.
    dealt = wanted.withColumn("set", F.pmod(F.xxhash64("item", "item_text"), F.lit(sets)))
    dealt = dealt.repartition(sets, "set").sortWithinPartitions("set", "item", "item_text")
    built = dealt.mapInArrow(lambda it: _build(it, folder, window), _SET)
    return [r.asDict() for r in built.collect()]


def hits_of(
    spark: SparkSession,
    benchmark: DataFrame,
    *,
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_pattern_words: int = MAX_PATTERN_WORDS,
) -> Callable[[Column], Column]:
    """A column function from text to n_words, n_hit and the sorted ids of the items that occur in it.

    ``max_pattern_words`` bounds a pattern set, and does not change the result.
    """
    folder = work_folder(spark, "patterns")
    sets = pattern_sets(benchmark, folder, item=item, text=item_text, window=window, max_words=max_pattern_words)

    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _scan(texts, folder, sets)

    scan.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Not pushed below other steps, which would scan twice.
    return F.arrow_udf(scan, _SCAN).asNondeterministic()


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, *, keys: list[str], text: str = "text", **options) -> DataFrame:
    """``keys`` of each document with n_words, n_hit and the sorted ids of the items that occur in it."""
    hits = hits_of(text_batches(docs), benchmark, **options)
    found = docs.select(*keys, hits(F.col(f"`{text}`")).alias("__hits"))
    return found.select(*keys, *[F.col(f"__hits.{c}").alias(c) for c in ("n_words", "n_hit", "items")])


def contaminated():
    """Some word is hit, and at least one in twenty."""
    return (F.col("n_hit") > 0) & (CONTAMINATED_SHARE * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all columns, without the contaminated ones; one scan, no shuffle, and texts stay on their side."""
    hits = hits_of(text_batches(docs), benchmark, **options)
    found = packed(docs).withColumn("hits", hits(F.col("text"))).select("row", "text", "hits.n_words", "hits.n_hit")
    return unpacked(found.filter(~contaminated()), docs.columns)


def op5_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    hits = benchmark_hits(docs, table(spark, sf, "benchmark"), keys=["doc_id"])
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS pat
      FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM p),
x AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS pat
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
h AS (SELECT DISTINCT x.doc_id, x.i, x.n, p.item FROM x JOIN p ON x.pat = p.pat AND x.n = p.n),
hw AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
