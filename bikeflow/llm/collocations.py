r"""Phrase collocations by best-first branch and bound.

Phrases grow word by word along a tree of prefixes. With f the number of occurrences, no phrase that begins
with a prefix p = (w, ...) occurs more often than p, and what follows w in it occurs at least as often as the
phrase itself; so the score at the first cut, and with it the lowest one, is at most 10^6 * f(p) / f(w). For one
word this bound is 10^6: every word that is frequent enough is expanded, which gives all pairs. The pairs are
the frontier of each language, in the order of their bounds. Rounds expand the best of them: a language's
threshold is the score that a growing number of pairs reach, and all prefixes with a bound of the threshold or
more are expanded together, as one pass over the texts counts the extensions of any number of them. The same
pass counts what ends with a pair that scores the threshold, as a longer phrase on its left may drop the pair.
A language is settled once that many phrases of its threshold or more survive as are wanted: then every open
prefix has a smaller bound, ties of the last place are all in, and the language takes no part in later rounds.

Words are named by 64-bit hashes of language and text while they are counted, and their texts are read
again for the phrases that may be listed. A pass gets the frontier as bitmaps of fixed size: a
prefix that shares a bit with another one is counted for nothing, and no result depends on it. Among F frequent
and V distinct words a shared hash has probability F V / 2^64; one that reaches the result stops the job.

Defined cases: a null text is empty, a null language "und"; texts without words add nothing; equal texts and
equal ids count as often as they stand there; a language with fewer surviving phrases lists them all; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikeflow.llm import textbytes as tb
from bikeflow.llm.tables import Workspace, table, text_batches

LEAST = 10  # occurrences of a candidate
TOP = 2000  # phrases listed per language
INSIDE = 50  # a longer phrase with this share of the occurrences, in percent, drops a candidate
UNIT = 1_000_000
UNKNOWN = "und"
# Pairs that the first round expands per language, as a multiple of the wanted phrases, and the growth of later ones.
FIRST, GROWTH = 2, 8
SLICE_BYTES = 1 << 21
BITMAP_BITS = 26  # 8 MB, however many keys there are
STEP = 1000  # resolution of thresholds

_BREAK = tb.byte_class((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
WORD_BYTES = ~(_BREAK | tb.byte_class((0x20, 0x20), (0x09, 0x09)))


class Bitmap:
    """Which keys may be in a set: a bit per leading bits of the key, so equal keys share it."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        bit = keys >> np.uint64(64 - BITMAP_BITS)
        return (self.cells[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(keys: DataFrame) -> Bitmap:
    """Of the column ``key``; what reaches the driver has a fixed size."""
    bit = F.shiftrightunsigned("key", 64 - BITMAP_BITS)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    cells = keys.select(F.shiftright(bit, 6).alias("cell"), one.alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    found = cells.toArrow()
    held = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    held[found.column("cell").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Bitmap(held)


def joined(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A key of two keys, for bitmaps."""
    return tb.mix(one * np.uint64(3) + two)


class Words:
    """The words of some texts: keys, and whether the next word follows in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        self.data = tb.LOWER[data]
        self.starts, self.ends, before = tb.word_bounds(self.data, offsets, WORD_BYTES)
        counts = np.diff(before)
        self.lang = np.repeat(langs, counts)
        names = tb.mix(tb.span_hashes(self.data, self.starts, self.ends) + self.lang)
        piece = np.cumsum(_BREAK[self.data])[self.starts]
        text = np.repeat(np.arange(len(counts)), counts)
        self.next = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        self.keys, self.first, self.code = np.unique(names, return_index=True, return_inverse=True)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        langs = batch.column("lang_key").to_numpy().view(np.uint64)
        for first, last, data, offsets in tb.slices(batch.column("text"), SLICE_BYTES):
            yield Words(data, offsets, langs[first:last])


def _batch(**columns) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64)) if isinstance(c, np.ndarray) else c for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _words(batches):
    for w in _slices(batches):
        yield _batch(lang_key=w.lang[w.first], key=w.keys, n=np.bincount(w.code, minlength=len(w.keys)))


def _texts(batches, wanted: Bitmap):
    for w in _slices(batches):
        at = np.flatnonzero(wanted(w.keys))
        raw = w.data.tobytes()
        spans = zip(w.starts[w.first[at]].tolist(), w.ends[w.first[at]].tolist())
        yield _batch(key=w.keys[at], word=pa.array([raw[a:b].decode() for a, b in spans], pa.string()))


def _pairs(batches, frequent: Bitmap):
    for w in _slices(batches):
        live = frequent(w.keys)[w.code]
        at = np.flatnonzero(w.next & live[1:] & live[:-1])
        size = np.int64(len(w.keys))
        found, n = np.unique(w.code[at] * size + w.code[at + 1], return_counts=True)
        yield _batch(k1=w.keys[found // size], k2=w.keys[found % size], n=n)


def _triples(batches, frequent: Bitmap, heads: Bitmap, tails: Bitmap):
    for w in _slices(batches):
        live = frequent(w.keys)[w.code]
        at = np.flatnonzero(w.next[1:] & w.next[:-1] & live[2:] & live[1:-1] & live[:-2])
        one, two, three = (w.keys[w.code[at + k]] for k in range(3))
        at = at[heads(joined(one, two)) | tails(joined(two, three))]
        # Numbers of the pairs in this slice keep the product below 64 bits.
        size = np.int64(len(w.keys))
        first, place = np.unique(w.code[at] * size + w.code[at + 1], return_inverse=True)
        found, n = np.unique(place * size + w.code[at + 2], return_counts=True)
        pair = first[found // size] if len(first) else found
        yield _batch(k1=w.keys[pair // size], k2=w.keys[pair % size], k3=w.keys[found % size], n=n)


def _wide(column: str):
    return F.col(column).cast("decimal(19,0)")


def _score(a: str, l: str, r: str):
    """floor(10^6 a^2 / (l r)) in 38 digits, which hold a up to 10^16."""
    product = (_wide(a) * _wide(a)).cast("decimal(32,0)") * F.lit(UNIT).cast("decimal(7,0)")
    return F.call_function("div", product.cast("decimal(38,0)"), (_wide(l) * _wide(r)).cast("decimal(38,0)"))


def _keys_of_pairs(batches):
    for batch in batches:
        one, two = (batch.column(c).to_numpy().view(np.uint64) for c in ("k1", "k2"))
        yield _batch(key=joined(one, two))


def pair_bitmap(pairs: DataFrame) -> Bitmap:
    return bitmap(pairs.select("k1", "k2").mapInArrow(_keys_of_pairs, "key long"))


def thresholds(pairs: DataFrame, open_langs: DataFrame, reached: int) -> DataFrame:
    """(lang_key, least): the score, rounded down to steps, that at least ``reached`` pairs of the language have.

    0 where there are fewer. The scores are at most 10^6, so a language has a thousand steps at most.
    """
    steps = pairs.join(open_langs, "lang_key").groupBy("lang_key", F.expr(f"score div {STEP}").alias("step")).agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("lang_key").orderBy(F.desc("step")))
    met = steps.withColumn("above", above).groupBy("lang_key").agg(F.max(F.when(F.col("above") >= reached, F.col("step"))).alias("step"))
    return met.select("lang_key", (F.coalesce("step", F.lit(0)) * STEP).alias("least"))


def collocations(
    docs: DataFrame,
    *,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    top: int = TOP,
    inside: int = INSIDE,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases of two and three words."""
    spark = text_batches(docs)
    work = Workspace(spark, "collocations")
    name = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN))
    source = docs.select(name.alias("lang"), F.xxhash64(name).alias("lang_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    texts = source.select("lang_key", "text")

    def counted(function, keys: list[str], *maps: Bitmap) -> DataFrame:
        held = [spark.sparkContext.broadcast(m) for m in maps]
        schema = ", ".join(f"{c} long" for c in [*keys, "n"])
        found = texts.mapInArrow(lambda it: function(it, *(h.value for h in held)), schema)
        return found.groupBy(*keys).agg(F.sum("n").alias("f"))

    # One word: the bound prunes none of them.
    words = work.land(counted(_words, ["lang_key", "key"]), "words")
    totals = words.groupBy("lang_key").agg(F.sum("f").alias("n"))
    words = work.land(words.filter(F.col("f") >= least), "frequent words")
    frequent = bitmap(words)

    # Two words, with the bound of what begins with them.
    pairs = counted(_pairs, ["k1", "k2"], frequent).filter(F.col("f") >= least).withColumnRenamed("f", "a")
    pairs = pairs.join(words.select(F.col("key").alias("k1"), F.col("f").alias("l"), "lang_key"), "k1")
    pairs = pairs.join(words.select(F.col("key").alias("k2"), F.col("f").alias("r")), "k2")
    bound = F.call_function("div", (_wide("a") * F.lit(UNIT)).cast("decimal(38,0)"), _wide("l"))
    pairs = work.land(pairs.select("lang_key", "k1", "k2", "a", "l", "r", _score("a", "l", "r").alias("score"), bound.alias("bound")), "pairs")

    open_langs = work.land(pairs.select("lang_key").distinct(), "open")
    triples = _scored_triples(pairs.limit(0).select("k1", "k2", F.col("k2").alias("k3"), F.col("a").alias("f")), pairs)
    settled = open_langs.limit(0).withColumn("least", F.lit(0).cast("long"))
    rounds, reached = 0, FIRST * top
    while not open_langs.isEmpty():
        now = work.land(thresholds(pairs, open_langs, reached), "thresholds")
        near = pairs.join(now, "lang_key")
        heads, tails = (pair_bitmap(near.filter(f"{value} >= least")) for value in ("bound", "score"))
        found = counted(_triples, ["k1", "k2", "k3"], frequent, heads, tails).filter(F.col("f") >= least)
        found = _scored_triples(found, pairs)
        if rounds:  # a triple that an earlier round counted has the same numbers
            found = found.join(triples.select("k1", "k2", "k3"), ["k1", "k2", "k3"], "left_anti")
        found = work.land(found, "triples")
        triples = triples.unionByName(found) if rounds else found
        kept = _survivors(pairs, triples, now, inside).groupBy("lang_key").agg(F.count("*").alias("kept"))
        state = now.join(kept, "lang_key", "left")
        state = work.land(state.withColumn("done", (F.col("least") == 0) | (F.coalesce("kept", F.lit(0)) >= top)), "state")
        ended = state.filter("done").select("lang_key", "least")
        settled = settled.unionByName(ended) if rounds else ended
        open_langs = state.filter("not done").select("lang_key")
        rounds, reached = rounds + 1, reached * GROWTH

    kept = _survivors(pairs, triples, settled, inside)
    best = work.land(_within(kept, top), "best")
    return _listed(best, source, totals, top)


def _scored_triples(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both cuts from the counts of the two pairs inside, which are as frequent at least."""
    head = pairs.select("k1", "k2", F.col("a").alias("head"), F.col("l").alias("first"), "lang_key")
    tail = pairs.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("a").alias("tail"), F.col("r").alias("last"))
    rows = counts.withColumnRenamed("f", "a").join(head, ["k1", "k2"]).join(tail, ["k2", "k3"])
    rows = rows.withColumns({"one": _score("a", "first", "tail"), "two": _score("a", "head", "last")})
    early = F.col("one") <= F.col("two")
    return rows.select(
        "k1", "k2", "k3", "a", "lang_key",
        F.when(early, F.col("first")).otherwise(F.col("head")).alias("l"),
        F.when(early, F.col("tail")).otherwise(F.col("last")).alias("r"),
        F.least("one", "two").alias("score"),
    )


def _survivors(pairs: DataFrame, triples: DataFrame, limits: DataFrame, inside: int) -> DataFrame:
    """Phrases of the languages in ``limits`` with the score named there: pairs that no longer phrase drops, and triples."""
    parts = triples.select("k1", "k2", "a").unionAll(triples.select("k2", "k3", "a"))
    longer = parts.groupBy("k1", "k2").agg(F.max("a").alias("longer"))
    kept = pairs.join(limits, "lang_key").filter("score >= least").join(longer, ["k1", "k2"], "left")
    kept = kept.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside))
    columns = ["lang_key", "k1", "k2", "k3", "a", "l", "r", "score"]
    best = triples.join(limits, "lang_key").filter("score >= least")
    return kept.withColumn("k3", F.lit(None).cast("long")).select(*columns).unionByName(best.select(*columns))


def _within(kept: DataFrame, top: int) -> DataFrame:
    """Phrases with the score and count of a language's last place, or better: all that texts can still rank.

    The last place is among the first ``top`` distinct pairs of score and count, so few rows meet per language.
    """
    order = Window.partitionBy("lang_key").orderBy(F.desc("score"), F.desc("a"))
    grades = kept.groupBy("lang_key", "score", "a").agg(F.count("*").alias("n"))
    grades = grades.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    grades = grades.withColumn("before", F.sum("n").over(order) - F.col("n")).filter(F.col("before") < top)
    return kept.join(grades.select("lang_key", "score", "a"), ["lang_key", "score", "a"])


def _listed(best: DataFrame, source: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The phrases with their texts, and the final order."""
    spark = best.sparkSession
    used = best.select(F.explode(F.array("k1", "k2", "k3")).alias("key")).filter("key is not null").distinct()
    wanted = spark.sparkContext.broadcast(bitmap(used))
    texts = source.select("lang_key", "text").mapInArrow(lambda it: _texts(it, wanted.value), "key long, word string")
    texts = texts.join(used, "key", "left_semi").groupBy("key").agg(F.min("word").alias("word"), F.max("word").alias("other"))
    same = F.when(F.col("word") == F.col("other"), F.col("word")).otherwise(F.raise_error(F.lit("two words share a 64-bit hash")))
    texts = texts.select("key", same.alias("word"))
    rows = best
    for k in (1, 2, 3):
        rows = rows.join(texts.select(F.col("key").alias(f"k{k}"), F.col("word").alias(f"w{k}")), f"k{k}", "left")
    names = source.select("lang", "lang_key").distinct()
    rows = rows.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    order = Window.partitionBy("lang_key").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    rows = rows.join(names, "lang_key").join(totals, "lang_key")
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, doc_id,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x{0A}-\x{0D}]')) AS piece
           FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x{20}\x{09}]+') AS w FROM d),
g AS (SELECT lang, k, CASE k WHEN 1 THEN w[i] WHEN 2 THEN concat_ws(' ', w[i], w[i + 1]) ELSE concat_ws(' ', w[i], w[i + 1], w[i + 2]) END AS phrase,
             w[i] AS w1, CASE WHEN k > 1 THEN w[i + 1] END AS w2, CASE WHEN k > 2 THEN w[i + 2] END AS w3
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, 1 AS cut, x.f AS l, y.f AS r FROM f c
    JOIN f x ON x.lang = c.lang AND x.k = 1 AND x.phrase = c.w1
    JOIN f y ON y.lang = c.lang AND y.k = c.k - 1 AND y.phrase = CASE c.k WHEN 2 THEN c.w2 ELSE concat_ws(' ', c.w2, c.w3) END WHERE c.k > 1 AND c.f >= 10
  UNION ALL
  SELECT c.lang, c.phrase, c.k, c.f, 2, x.f, y.f FROM f c
    JOIN f x ON x.lang = c.lang AND x.k = 2 AND x.phrase = concat_ws(' ', c.w1, c.w2)
    JOIN f y ON y.lang = c.lang AND y.k = 1 AND y.phrase = c.w3 WHERE c.k = 3 AND c.f >= 10),
scored AS (SELECT *, (1000000 * a * a) // (l * r) AS score FROM cuts),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS turn FROM scored) WHERE turn = 1),
longer AS (SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, concat_ws(' ', w1, w2) AS phrase, f FROM f WHERE k = 3 AND f >= 10
    UNION ALL SELECT lang, concat_ws(' ', w2, w3), f FROM f WHERE k = 3 AND f >= 10) GROUP BY lang, phrase),
kept AS (SELECT b.* FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase AND b.k = 2 WHERE x.f IS NULL OR 100 * x.f < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
