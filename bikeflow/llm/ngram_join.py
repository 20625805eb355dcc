"""Similarity join of word n-gram sets by parity sketches.

A document's set of hashed shingles is dealt to lanes, and each lane holds the exclusive or of its
shingles. Two documents' sketches differ in at most as many lanes as their sets differ in elements.
For each band of set sizes the largest possible symmetric difference D of a similar pair is known, so
with D + 1 lanes or more at least one lane is equal (pigeonhole): (band, lane, value) is the join key.
A document takes part in its own band and in those of larger documents it may still be similar to.

Not all lanes are needed. Lanes have an order that depends on their content only: those with most shingles
first, as lanes with one or none say little and make long lists. Of two documents that may differ in d lanes,
the first d + 1 lanes of either in that order have one in common, so each emits as many as its own size and
the band allow for. No link is lost.

Copies of equal sets are folded by digest first. Candidates are verified exactly (``candidates``).

Defined cases: a text without words, and a null text, has the empty set and no link; a text with
fewer words than a shingle is one shingle; rows with equal ids are one node, with the links of all
of them; a null id has no component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm import textbytes as tb
from bikeflow.llm.candidates import SETS, candidate_groups, set_bytes, verified_links
from bikeflow.llm.graph import connected_components
from bikeflow.llm.tables import Workspace, landed, small_side, table, text_batches

WORD_BYTES = tb.byte_class((0x00, 0x08), (0x0E, 0x1F), (0x21, 0xFF))
BAND_RATIO = 2


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for first, last, data, offsets in tb.slices(texts):
        data = tb.LOWER[data]
        starts, ends, before = tb.word_bounds(data, offsets, WORD_BYTES)
        words = tb.span_hashes(data, starts, ends)
        shingles = tb.chained(words, width)
        for k in range(last - first):
            low, high = before[k], before[k + 1]
            if high - low >= width:
                found = np.sort(shingles[low : high - width + 1])
                yield found[np.concatenate([[True], found[1:] != found[:-1]])]
            else:
                yield tb.chained(words[low:high], high - low) if high > low else np.zeros(0, np.uint64)


@cache
def bands(num: int, den: int, largest: int) -> list[tuple[int, int, int]]:
    """(smallest size, past largest size, lanes) of each band up to a set size."""
    found, low = [], 1
    while low <= largest:
        high = low * BAND_RATIO
        found.append((low, high, (den - num) * 2 * (high - 1) // (den + num) + 1))
        low = high
    return found


def sketch_keys(found: np.ndarray, num: int, den: int) -> np.ndarray:
    """The join keys of one set."""
    size, keys = len(found), []
    for band, (low, high, lanes) in enumerate(bands(num, den, 1 << max(4, size.bit_length() + 1))):
        apart = (den - num) * (size + min(high - 1, size * den // num)) // (den + num)
        if size >= high or low * num > size * den or not apart:
            continue  # another band, or only equal sets are similar there
        spread = tb.mix(found + np.uint64(band + 1))
        lane = ((spread >> np.uint64(32)) * np.uint64(lanes) >> np.uint64(32)).astype(np.int64)
        value = np.zeros(lanes, np.uint64)
        np.bitwise_xor.at(value, lane, spread)
        held = np.bincount(lane, minlength=lanes)
        key = tb.mix(value + tb.mix(np.arange(lanes, dtype=np.uint64) + np.uint64(band << 32)))
        keys.append(key[np.lexsort((key, -held))[: apart + 1]])
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _digest(found: np.ndarray) -> tuple[int, int]:
    one, two = tb.mix(found + np.uint64(7)), tb.mix(found ^ np.uint64(0x5555555555555555))
    return int(np.bitwise_xor.reduce(one).astype(np.int64)), int(two.sum(dtype=np.uint64).astype(np.int64))


def _sizes(batches, text: str, width: int):
    for batch in batches:
        sets = list(shingle_sets(batch.column(text), width))
        digests = [_digest(s) for s in sets]
        columns = [pa.array([len(s) for s in sets], pa.int64())]
        columns += [pa.array([d[k] for d in digests], pa.int64()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n", "one", "two"])


def _keys(batches, text: str, width: int, num: int, den: int):
    seen = set()
    for batch in batches:
        ids = batch.column("id").to_pylist()
        keys, owners, held = [], [], 0
        for row, found in zip(ids, shingle_sets(batch.column(text), width)):
            if len(found) and (digest := _digest(found)) not in seen:
                seen.add(digest)  # further copies in this task have no keys of their own
                keys.append(sketch_keys(found, num, den))
                owners.append(np.full(len(keys[-1]), row, np.int64))
                held += len(keys[-1])
            if held > 200_000:
                yield _key_batch(keys, owners)
                keys, owners, held = [], [], 0
        if keys:
            yield _key_batch(keys, owners)


def _key_batch(keys, owners):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))], ["key", "id"]
    )


def _members(batches, text: str, width: int):
    for batch in batches:
        sets = [set_bytes(s) for s in shingle_sets(batch.column(text), width)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("group"), batch.column("id"), pa.array(sets, pa.binary())], ["group", "id", "elements"]
        )


def similar_components(
    docs: DataFrame, *, width: int, num: int, den: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, n_shingles and component_id (smallest id reachable by links of num/den or more)."""
    spark = text_batches(docs)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    work = Workspace(spark, "similar-documents")
    sized = work.land(rows.mapInArrow(lambda it: _sizes(it, "text", width), "id long, n long, one long, two long"), "sizes")
    known = rows.filter("id is not null")

    keys = known.mapInArrow(lambda it: _keys(it, "text", width, num, den), "key long, id long")
    groups = work.land(candidate_groups(keys), "groups")
    chosen = known.join(small_side(groups, groups.count()), "id").select("group", "id", "text")
    links = verified_links(chosen.mapInArrow(lambda it: _members(it, "text", width), SETS), num, den, work)

    classes = sized.filter("n > 0 and id is not null")
    first = classes.groupBy("n", "one", "two").agg(F.min("id").alias("a"), F.count("*").alias("rows"))
    first = first.filter("rows > 1").drop("rows")
    copies = classes.join(first, ["n", "one", "two"]).select("a", F.col("id").alias("b"))
    found = connected_components(links.unionByName(copies))
    work.drop("groups", "members")
    return sized.join(found, "id", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )


def keep_first(docs: DataFrame, *, width: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """The documents, all columns, of which no similar one has a smaller id.

    Rows with equal ids stay or go together; rows with a null id stay.
    """
    spark = docs.sparkSession
    found = similar_components(docs, width=width, num=num, den=den)
    gone = landed(spark, found.filter("component_id < doc_id").select("doc_id").distinct(), "later")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id"))
    return packed.join(small_side(gone, gone.count()), "doc_id", "left_anti").select("row.*")


def op8_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return similar_components(table(spark, sf, "documents"), width=3, num=90, den=100)


OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x{20}\x{09}-\x{0D}]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
rare AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id
      WHERE x.g IN (SELECT g FROM rare) GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 90 * (na.n + nb.n - shared)),
r AS (SELECT doc_id AS id, doc_id AS reach FROM documents
      UNION SELECT r.id, z.b FROM r JOIN (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) z ON z.a = r.reach)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(reach) AS component_id FROM r GROUP BY id) c ON c.id = d.doc_id
"""
