"""Whitening of vectors by shifted CholeskyQR.

Entries become integers, so their sums are exact and a row is centred by one rounding. The centred rows A are
never factored as a covariance, which would square their condition. Each pass forms the Gram matrix of the rows as
they are orthogonalised so far, every task adding up its own rows and few tasks adding up those. The Cholesky factor of the first one, its
diagonal shifted by the rounding that the sum may carry, exists for any rows; solving the rows against it leaves
them well-conditioned, and the next passes, without a shift, make them orthonormal. Tasks solve rows against each
triangular factor in turn, and the factors' product R is all that the driver holds besides: A = QR. The singular
values and right vectors of R are those of A, so they give the components with their variances. One more pass measures the covariance of the whitened rows.

Every pass reads the vectors again and shuffles a matrix per task; nothing depends on keys. The square of the
dimension must fit a task.

Defined cases: vectors that are null or hold null or non-finite entries, or entries beyond 2^52 in steps, take no
part, nor do those whose length is not the most frequent one (of equally frequent ones the longest) or is 0; null and repeated
ids and equal rows each count and keep a row each; directions without variance are no components, so one row, or equal rows only,
give no result, as does an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm.tables import table

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
LIMIT = 2**52
PASSES = 8
SUMMING_TASKS = 8
TOLERANCE = 1e-12

SCHEMA = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass
class Steps:
    """How entries become integers: floor(scale * entry) + offset, of vectors of one length."""

    width: int
    scale: float
    offset: int

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(places of the rows that take part, their integers)."""
        fits = pc.fill_null(pc.equal(pc.list_value_length(column), self.width), False)
        flat = column.filter(fits).flatten().cast(pa.float64())
        values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, self.width)
        values = np.floor(values * self.scale)
        good = (np.abs(values) < LIMIT).all(axis=1)  # false for what is not finite
        return np.flatnonzero(fits.to_numpy(zero_copy_only=False))[good], values[good].astype(np.int64) + self.offset


@dataclass
class Centre:
    """Count and sums of the fit list."""

    n: int
    sums: np.ndarray

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        """n times the centred rows, exact."""
        if self.n * (LIMIT + OFFSET) >= 2**62 and self.n * int(np.abs(rows).max(initial=0)) >= 2**62:
            raise OverflowError("counts times entries beyond 2^62 are not exact here")
        return rows * self.n - self.sums


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """X with X @ factor = rows, for an upper triangular factor, column by column."""
    out = np.empty_like(rows, order="F")
    for k in range(len(factor)):
        out[:, k] = (rows[:, k] - out[:, :k] @ factor[:k, k]) / factor[k, k]
    return out


def squares(values: np.ndarray) -> pa.Array:
    """The exact sum of the squares of each row, in 38 digits."""
    most = int(np.abs(values).max(initial=0))
    if most**2 * max(1, values.shape[1]) < 2**63:
        low = (values * values).sum(axis=1)
        raw = np.stack([low, low >> 63], axis=1).tobytes()
    elif most < LIMIT and values.shape[1] <= 1024:
        high = (values + (1 << 25)) >> 26
        low = values - (high << 26)  # 26 and 27 bits: their products sum up in 64
        parts = ((high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))
        totals = ((a << 52) + (b << 27) + c for a, b, c in zip(*(p.tolist() for p in parts)))
        raw = b"".join(t.to_bytes(16, "little", signed=True) for t in totals)
    else:
        raw = b"".join(sum(v * v for v in row).to_bytes(16, "little", signed=True) for row in values.tolist())
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(values), [None, pa.py_buffer(raw)])


def added(parts: DataFrame, function: Callable[[pa.Array], np.ndarray | None], kind) -> np.ndarray | None:
    """The sum of what ``function`` gives for the batches of ``vector``: per task, in a few tasks, and at last here."""

    def within(batches: Iterator[pa.RecordBatch]):
        total = None
        for batch in batches:
            found = function(batch.column("vector"))
            if found is not None:
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def across(batches: Iterator[pa.RecordBatch]):
        total = None
        for batch in batches:
            for raw in batch.column("part"):
                found = np.frombuffer(raw.as_buffer(), kind)
                total = found.copy() if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    sums = parts.mapInArrow(within, "part binary").repartition(SUMMING_TASKS).mapInArrow(across, "part binary")
    found = [np.frombuffer(r.part, kind) for r in sums.collect()]  # one per summing task at most
    return sum(found[1:], found[0]) if found else None


@dataclass
class Whitening:
    """What turns rows into whitened ones, and how well it did so on the fit list."""

    steps: Steps
    centre: Centre
    axes: np.ndarray  # a unit component per column
    variances: np.ndarray
    trace: float
    passes: int
    identity_error: float = 0.0

    def __call__(self, centred: np.ndarray) -> np.ndarray:
        return (centred @ self.axes) / np.sqrt(self.variances)


def _upper(gram: np.ndarray, shift: float) -> np.ndarray:
    return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T


def factored(vectors: DataFrame, steps: Steps, centre: Centre) -> tuple[np.ndarray, int]:
    """(R, passes) with R'R = A'A for the centred rows A."""
    width, product, factors = steps.width, np.eye(steps.width), []
    rounding = 11 * (centre.n * width + width * (width + 1)) * 2.0**-53

    def gram(column):
        _, rows = steps(column)
        rows = centre.scaled(rows) / centre.n
        for factor in factors:
            rows = solved(rows, factor)
        return rows.T @ rows

    for turn in range(1, PASSES + 1):
        now = added(vectors, gram, np.float64).reshape(width, width)
        now = (now + now.T) / 2
        size = float(np.trace(now))
        # Rows without variance in some direction never become orthonormal there: their Gram matrix ends as a projector.
        if turn > 1 and np.abs(now @ now - now).max() <= TOLERANCE or size == 0:
            break
        if turn == PASSES:
            break
        try:
            factor = _upper(now, min(rounding, 0.5) * size if turn == 1 else 0.0)
            if turn > 1 and factor.diagonal().min() < rounding:
                raise np.linalg.LinAlgError
        except np.linalg.LinAlgError:
            factor = _upper(now, max(min(rounding, 0.5) * size, 2.0**-40))
        factors.append(factor)
        product = factor @ product
    values, axes = np.linalg.eigh(now)
    return (axes * np.sqrt(np.maximum(values, 0))) @ axes.T @ product, turn


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE, offset: int = OFFSET) -> Whitening | None:
    """Of a column ``vector``; None if no direction has variance."""
    sizes = vectors.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("size")).count()
    width = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if width is None:
        return None
    steps = Steps(width[0], scale, offset)

    def totals(column):
        _, rows = steps(column)
        return np.concatenate([[len(rows)], rows.sum(axis=0)]).astype(np.int64)

    found = added(vectors, totals, np.int64)
    if found is None or not found[0]:
        return None
    centre = Centre(int(found[0]), found[1:])
    factor, passes = factored(vectors, steps, centre)
    _, sizes, axes = np.linalg.svd(factor)
    rank = int((sizes > sizes[0] * 16 * len(sizes) * 2.0**-52).sum())
    if not rank:
        return None
    axes = axes[: min(rank, components)].T
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None, :], 0) < 0, -1.0, 1.0)
    variances = sizes**2 / centre.n
    model = Whitening(steps, centre, axes, variances[: axes.shape[1]], float(variances.sum()), passes)

    def covariance(column):
        _, rows = steps(column)
        white = model(centre.scaled(rows) / centre.n)
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    found = added(vectors, covariance, np.float64) / centre.n
    k = axes.shape[1]
    means, products = found[:k], found[k:].reshape(k, k)
    model.identity_error = float(np.abs(products - np.outer(means, means) - np.eye(k)).max())
    return model


def _apply(batches: Iterator[pa.RecordBatch], model: Whitening, key: str):
    k = model.axes.shape[1]
    explained = model.variances / model.trace
    for batch in batches:
        at, rows = model.steps(batch.column("vector"))
        exact = model.centre.scaled(rows)
        white = model(exact / model.centre.n)
        owner = np.repeat(np.arange(len(rows)), k)
        arrays = [
            batch.column(key).take(pa.array(at[owner])),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
            pa.array(np.full(len(owner), model.centre.n)),
            squares(exact).take(pa.array(owner)),
            pa.array(white.ravel()),
            pa.array(np.tile(explained, len(rows))),
            pa.array(np.full(len(owner), model.identity_error)),
        ]
        yield pa.RecordBatch.from_arrays(arrays, [key, *(c.split()[0] for c in SCHEMA.split(", "))])


def whitened(
    rows: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: float = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """``key`` and, per component from 1 on, the row's whitened coordinate with what describes the fit."""
    rows = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector"))
    model = fit(rows.select("vector"), components, scale, offset)
    schema = f"key {rows.schema['key'].dataType.simpleString()}, {SCHEMA}"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    return rows.mapInArrow(lambda it: _apply(it, model, "key"), schema).withColumnRenamed("key", key)


def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitened(table(spark, sf, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))
