"""Toxicity by class-conditional Kneser-Ney models.

Both classes predict each byte of a text (letters in lower case, digits alike, all else a space) from
up to five before it in its word. The top order counts are the class's own; every lower order is shared: continuation
counts of both classes together, so that a rare expression falls back to the same estimate in either and
counts as evidence only as far as a class has seen it. The ordinary class has far more text, which alone
would make unseen expressions look toxic; its counts enter as the expectation over a thinning of its text
to the toxic class's size.

The log-likelihood ratio is normalised by length twice: per byte over the whole text, and per word. A
logistic curve over the text's mean per byte, its best word and the mean of its three best words gives the
score. The curve is fitted on a fifth of the labelled rows (at most CURVE_ROWS of them), with counts of the
other four; the counts that score documents cover all labelled rows.

A model is a table of log ratios by n-gram and one by context, for n-grams that no class has seen. Tasks build
them in parts of bounded size, and they grow with the n-grams of the corpus. Scoring tasks map the files, and a look-up compares the
whole n-gram: an unseen one is never taken for another, and falls back to its context, or to no evidence.

Defined cases: null and empty texts have no evidence and get the curve's value at zero; several labels of
an id are toxic if any is; null labels and labels of absent ids are ignored; without labels of both
classes every score is 0.5 below the threshold; rows with equal ids are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikeflow.llm import textbytes as tb
from bikeflow.llm.lookup import SharedTable
from bikeflow.llm.tables import in_fold, landed, small_side, table, text_batches

ORDER = 6
DISCOUNT = 0.75
THRESHOLD = 0.7
CURVE_FIFTH = 5
CURVE_ROWS = 20_000
FEATURES = 3

_FORM = np.full(256, 0x20, np.uint8)
_FORM[0x80:] = np.arange(0x80, 0x100)
_FORM[0x61:0x7B] = np.arange(0x61, 0x7B)
_FORM[0x41:0x5B] = np.arange(0x61, 0x7B)
_FORM[0x30:0x3A] = 0x30
_SPACE = np.uint8(0x20)
_SPACES = np.uint64(int.from_bytes(bytes([0x20] * ORDER)))
# The last 1, 2, ... bytes of an n-gram.
_OWN = np.array([(1 << (8 * (k + 1))) - 1 for k in range(ORDER)], np.uint64)


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with ORDER spaces before each and one behind, so no n-gram spans two of them."""
    gaps = ORDER * (np.arange(len(offsets) - 1) + 1)
    wide = np.full(len(data) + ORDER * len(offsets), _SPACE, np.uint8)
    wide[np.arange(len(data)) + np.repeat(gaps, np.diff(offsets))] = _FORM[data]
    return wide, offsets[:-1] + gaps


def grams(wide: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte, from the ORDER-th on, as a number of 8 * ORDER bits.

    What stands before the byte's word counts as spaces, so a word is predicted from its own beginning.
    """
    n = len(wide) - ORDER + 1
    packed = np.zeros(max(n, 0), np.uint64)
    for k in range(ORDER):
        packed = (packed << np.uint64(8)) | wide[k : k + n].astype(np.uint64)
    heads = np.where(np.concatenate([[True], wide[:-1] == _SPACE]), np.arange(len(wide)), 0)
    own = (np.arange(len(wide)) - np.maximum.accumulate(heads))[ORDER - 1 :]
    mask = _OWN[np.minimum(own, ORDER - 1)]
    return (packed & mask) | (_SPACES & ~mask)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return gram, np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of each class in one task; what is held back is merged as it grows."""
    held: list[list] = [[], []]
    for batch in batches:
        labels = batch.column("toxic").to_numpy(zero_copy_only=False)
        for kind in (0, 1):
            texts = batch.column("text").filter(pa.array(labels == kind))
            for _, _, data, offsets in tb.slices(texts):
                wide, _ = spaced(data, offsets)
                held[kind].append(np.unique(grams(wide), return_counts=True))
            if sum(len(g) for g, _ in held[kind]) > 2_000_000:
                held[kind] = [_merged(held[kind])]
    for kind in (0, 1):
        gram, n = _merged(held[kind]) if held[kind] else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for at in range(0, len(gram), 100_000):
            part = slice(at, at + 100_000)
            columns = [gram[part].astype(np.int64), np.full(len(n[part]), kind, np.int64), n[part]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "toxic", "n"])


def _shared(counted: DataFrame) -> DataFrame:
    """(gram of the last ORDER - 1 bytes, p) by interpolated continuation counts of every lower order."""
    orders = {}
    below = counted.select("gram")
    for k in range(ORDER - 1, 0, -1):
        mask = (1 << (8 * k)) - 1
        below = below.groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count("*").alias("n"))
        orders[k] = below
        below = below.select("gram")
    p = None
    for k in range(1, ORDER):
        same = Window.partitionBy(F.shiftright("gram", 8))
        level = orders[k].select(
            "gram", "n", F.sum("n").over(same).alias("total"), F.count("*").over(same).alias("kinds")
        )
        if p is None:
            level = level.withColumn("lower", F.lit(1 / 256))
        else:
            mask = (1 << (8 * (k - 1))) - 1
            level = level.withColumn("tail", F.col("gram").bitwiseAND(F.lit(mask)))
            level = level.join(p.select(F.col("gram").alias("tail"), F.col("p").alias("lower")), "tail")
        p = level.select("gram", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("lower")) / F.col("total")).alias("p"))
    return p


def ratios(counts: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Log ratios of toxic to ordinary: (key, value) by n-gram and, for unseen n-grams, by context.

    ``counts``: gram, toxic (0 or 1), n.
    """
    spark = counts.sparkSession
    of = lambda kind: F.sum(F.when(F.col("toxic") == kind, F.col("n")).otherwise(0)).cast("double")
    both = landed(spark, counts.groupBy("gram").agg(of(1).alias("t"), of(0).alias("o")), "grams")
    total = both.agg(F.sum("t"), F.sum("o")).first()
    if not total[0] or not total[1]:
        return None
    both = both.withColumn("o", F.col("o") * min(1.0, total[0] / total[1]))
    both = both.withColumn("t", F.col("t") * min(1.0, total[1] / total[0]))
    whole = {"t": total[0] <= total[1], "o": total[1] <= total[0]}  # classes that are not thinned

    def seen(c):  # the chance that some of it survives the thinning
        return (F.col(c) > 0).cast("double") if whole[c] else 1 - F.exp(-F.col(c))

    same = Window.partitionBy(F.shiftright("gram", 8))
    level = both.select(
        "gram",
        "t",
        "o",
        F.shiftright("gram", 8).alias("context"),
        F.col("gram").bitwiseAND(F.lit((1 << (8 * (ORDER - 1))) - 1)).alias("tail"),
        *[F.sum(c).over(same).alias(f"{c}_all") for c in "to"],
        *[F.sum(seen(c)).over(same).alias(f"{c}_kinds") for c in "to"],
    )
    gamma = {c: F.when(F.col(f"{c}_all") > 0, DISCOUNT * F.col(f"{c}_kinds") / F.col(f"{c}_all")).otherwise(1.0) for c in "to"}
    level = level.join(_shared(both).select(F.col("gram").alias("tail"), "p"), "tail")
    own = {c: F.when(F.col(f"{c}_all") > 0, (F.col(c) - DISCOUNT * seen(c)) / F.col(f"{c}_all")).otherwise(0.0) for c in "to"}
    value = F.log((own["t"] + gamma["t"] * F.col("p")) / (own["o"] + gamma["o"] * F.col("p")))
    level = level.select("gram", "context", value.alias("value"), F.log(gamma["t"] / gamma["o"]).alias("backoff"))
    level = landed(spark, level, "ratios")
    by_context = level.groupBy("context").agg(F.first("backoff").alias("value"))
    return level.select(F.col("gram").alias("key"), "value"), by_context.withColumnRenamed("context", "key")


def model_of(labelled: DataFrame) -> tuple[SharedTable, SharedTable] | None:
    """The tables of a model counted on rows (toxic, text); None without both classes."""
    found = ratios(labelled.select("toxic", "text").mapInArrow(_count, "gram long, toxic long, n long"))
    return found and tuple(SharedTable(frame, name) for frame, name in zip(found, ("grams", "contexts")))


def features(texts: pa.Array, tables) -> np.ndarray:
    """Log ratio of each text per byte, of its best word, and of its three best words on average."""
    found = np.zeros((len(texts), FEATURES))
    for first, last, data, offsets in tb.slices(texts):
        wide, heads = spaced(data, offsets)
        gram = grams(wide)
        ratio = tables[0].get(gram)
        unseen = np.flatnonzero(np.isnan(ratio))
        ratio[unseen] = np.nan_to_num(tables[1].get(gram[unseen] >> np.uint64(8)))
        before = np.concatenate([np.zeros(ORDER), np.cumsum(ratio, dtype=np.float64)])  # sum over the bytes before k
        sizes = np.diff(offsets)
        found[first:last, 0] = (before[heads + sizes] - before[heads]) / np.maximum(sizes, 1)
        starts, ends, _ = tb.word_bounds(wide, np.array([0, len(wide)]), _WORD)
        word = before[ends + 1] - before[starts]
        edge = np.searchsorted(starts, np.concatenate([heads, [len(wide)]]))
        for k in range(last - first):
            own = word[edge[k] : edge[k + 1]]
            if len(own):
                best = own if len(own) <= 3 else np.partition(own, -3)[-3:]
                found[first + k, 1] = best.max()
                found[first + k, 2] = best.sum() / 3
    return found


_WORD = tb.byte_class((0x21, 0xFF))


def _features(batches, tables):
    for batch in batches:
        found = features(batch.column("text"), tables)
        kept = [c for c in batch.schema.names if c != "text"]
        arrays = [batch.column(c) for c in kept]
        yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(found[:, k]) for k in range(FEATURES)]], [*kept, "f0", "f1", "f2"])


def _curve(values: np.ndarray) -> np.ndarray:
    """Regressors of the logistic curve."""
    return np.column_stack([np.ones(len(values)), values[:, :FEATURES]])


def fit_curve(values: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton steps with a slight pull to zero."""
    x = _curve(values)
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], 1e-2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - p) - pull * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _score(batches, tables, weights):
    for batch in batches:
        x = _curve(features(batch.column("text"), tables))
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(p)], [*kept, "score"])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """``key`` and score of every document; ``labels`` are the ids and classes to learn from."""
    spark = text_batches(docs)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    known = landed(spark, known.withColumn("draw", F.xxhash64(F.col("id").cast("string"))), "labels")
    size = known.count()
    labelled = rows.join(small_side(known, size), "id")
    for_curve = F.pmod("draw", F.lit(CURVE_FIFTH)) == 0
    tables = model_of(labelled.filter(~for_curve))
    if tables is None:
        return docs.select(F.col(key), F.lit(0.5).alias("score"))

    share = min(1.0, CURVE_ROWS / max(1, size / CURVE_FIFTH))
    drawn = labelled.filter(for_curve & (F.pmod(F.xxhash64("draw"), F.lit(1_000_000)) < int(share * 1_000_000)))
    found = drawn.select("toxic", "text").mapInArrow(
        lambda it: _features(it, tables), "toxic int, f0 double, f1 double, f2 double"
    ).toArrow()
    values = np.column_stack([found[f"f{k}"].to_numpy() for k in range(FEATURES)])
    weights = fit_curve(values, found["toxic"].to_numpy())
    whole = model_of(labelled)
    scored = rows.mapInArrow(lambda it: _score(it, whole, weights), f"id {rows.schema['id'].dataType.simpleString()}, score double")
    return scored.withColumnRenamed("id", key)


def held_out(doc_id):
    return in_fold(doc_id, 3, 1)


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").filter(~held_out(F.col("doc_id")))
    scored = score_toxicity(table(spark, sf, "documents"), labels)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
