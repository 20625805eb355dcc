"""From rows that share a key to verified links, without listing the pairs of a group.

Rows that share a key are candidates. Each is tied to the smallest id of its key only, so a key with
n rows gives n - 1 ties, and connected ties give candidate groups: two rows that share any key are in
one group. The sets of a group's members are then compared in cells of bounded size. Inside a cell a
parity sketch (bit i is the parity of the elements hashed to i) gives a Hamming distance that never
exceeds the symmetric difference, so a pair whose sketches differ too much is skipped; the others are
verified exactly. A pair whose ends are already connected needs no test, and a cell returns a spanning
forest: components come out the same as from all links.

A group larger than a cell is split into blocks, and each pair of blocks is a cell of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikeflow.llm.graph import connected_components
from bikeflow.llm.tables import Workspace, small_side

BLOCK_ROWS = 2000
BLOCK_ELEMENTS = 1_000_000
SETS = "group long, id long, elements binary"


def candidate_groups(keys: DataFrame) -> DataFrame:
    """(id, group) of ids that share a key, from rows (key, id); ids alone in all their keys are left out."""
    first = F.min("id").over(Window.partitionBy("key"))
    ties = keys.withColumn("a", first).filter(F.col("a") != F.col("id")).select("a", F.col("id").alias("b"))
    return connected_components(ties).withColumnRenamed("component", "group")


def linked(ids: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links with intersection * den >= union * num, of sorted distinct sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    ids, sizes, sets = ids[order], sizes[order], [sets[k] for k in order]
    lanes = 4
    while lanes < 128 and lanes * 16 < sizes[-1]:
        lanes *= 2
    bits = np.zeros((len(ids), lanes * 64), np.uint8)
    for row, s in zip(bits, sets):
        row[:] = np.bincount((s >> np.uint64(17)).astype(np.int64) % (lanes * 64), minlength=lanes * 64) & 1
    sketches = np.packbits(bits, axis=1).view(np.uint64)
    label, edges = np.arange(len(ids)), []
    for i in range(len(ids)):
        stop = int(np.searchsorted(sizes, sizes[i] * den // num, "right"))
        later = np.arange(i + 1, stop)
        later = later[label[i + 1 : stop] != label[i]]
        if not len(later):
            continue
        apart = np.bitwise_count(sketches[later] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        near = apart * (den + num) <= (den - num) * (sizes[later] + sizes[i])
        for j in later[near][np.argsort(apart[near], kind="stable")].tolist():
            if label[j] != label[i]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both * den >= (sizes[i] + sizes[j] - both) * num:
                    edges.append((int(ids[i]), int(ids[j])))
                    label[label == label[j]] = label[i]
    return edges


def stored_sets(elements: pa.Array) -> Iterator[np.ndarray]:
    """The sets that ``set_bytes`` wrote."""
    return (np.frombuffer(e, np.uint64) for e in elements.to_pylist())


def _cells(
    batches: Iterator[pa.RecordBatch], num: int, den: int, sets_of: Callable[[pa.Array], Iterator[np.ndarray]]
) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell."""
    cell, ids, sets = None, [], []

    def found():
        edges = linked(np.array(ids, np.int64), sets, num, den) if len(ids) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"]
        )

    for batch in batches:
        cells = zip(*(batch.column(c).to_pylist() for c in ("group", "one", "two")))
        for at, row, elements in zip(cells, batch.column("id").to_pylist(), sets_of(batch.column("elements"))):
            if at != cell:
                if len(ids) > 1:
                    yield found()
                cell, ids, sets = at, [], []
            ids.append(row)
            sets.append(elements)
    yield found()


def verified_links(
    members: DataFrame,
    num: int,
    den: int,
    work: Workspace,
    sets_of: Callable[[pa.Array], Iterator[np.ndarray]] = stored_sets,
    weight: Column | None = None,
) -> DataFrame:
    """Edges (a, b) that connect what the links within each group connect.

    ``members``: group, id, elements. ``sets_of`` gives the set of each row (sorted distinct 64-bit hashes) from a
    batch of elements, where they are compared, and ``weight`` how many hashes these are at most; as given, the
    elements are the hashes' bytes. Members land in ``work`` under their name, from where the caller may drop
    them once the edges are used. Only groups larger than a cell have a size that their members must know.
    """
    members = work.land(members, "members")
    weight = F.octet_length("elements") / 8 if weight is None else weight
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum(weight) / BLOCK_ELEMENTS)).alias("blocks")
    large = work.land(members.groupBy("group").agg(blocks).filter("blocks > 1"), "large-groups")
    placed = members.join(small_side(large, large.count()), "group", "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))
    )
    placed = placed.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.array_remove(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), F.col("own"))
    )
    cells = placed.withColumn("other", F.explode(others)).select(
        "group", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "id", "elements"
    )
    cells = cells.repartition("group", "one", "two").sortWithinPartitions("group", "one", "two")
    return cells.mapInArrow(lambda it: _cells(it, num, den, sets_of), "a long, b long")


def set_bytes(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes, np.uint64).tobytes()
