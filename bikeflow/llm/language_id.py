"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of its labelled texts. A text is
parsed against it greedily: from each place the longest match with the sample is one phrase. Phrases
times log2 of the sample's length per byte estimate the cross entropy; the language with the smallest
estimate wins. A phrase does not cross the end of a block of 512 bytes, which lets numpy walk all
blocks of many texts through all automata in step; every byte of every text is parsed.

The sample is drawn evenly: per language (the 500 with most rows) the rows are counted, rows whose id hash falls below the
share that gives about twice the wanted number are fetched, and those of smallest hash are taken, one
of each distinct text. Only that fetch, bounded by its share, comes to the driver.

Defined cases: null texts, and texts without a letter, are "und" with score 0; ties go to the smaller
language name; with no labelled row at all every text is "und"; with one language every text with a
letter is of it, with score 1; copies and repeated rows are predicted one by one, each alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm import textbytes as tb
from bikeflow.llm.tables import SharedArray, in_fold, packed, table, text_batches, unpacked

UNKNOWN = "und"
SAMPLE_ROWS = 24  # per language
LANGUAGES = 500  # that are learned: those with most labelled rows
EXCERPT = 1500  # characters of a sampled row
BLOCK = 512
# A text whose two best languages are this close is in none of them.
MIN_SCORE = 0.001

_LETTER = re.compile(r"[^\W\d_]")
_FORM = np.full(256, 0x20, np.uint8)  # letters in lower case, all else a space
_FORM[0x80:] = np.arange(0x80, 0x100)
_FORM[0x61:0x7B] = np.arange(0x61, 0x7B)
_FORM[0x41:0x5B] = np.arange(0x61, 0x7B)
_GAP = 0  # stands between excerpts; no text has it


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transition table: a row per state and a column per symbol below ``width``; 0, the start, is none.

    The symbol -1 ends a text: what follows it is matched from the start.
    """
    table = np.zeros((2 * len(symbols) + 2, width), np.int32)
    link, length, last, states = [-1], [0], 0, 1
    for c in symbols:
        if c < 0:
            last = 0
            continue
        q = int(table[last, c])
        if q and length[q] == length[last] + 1:  # known from an earlier text
            last = q
            continue
        state, p = states, last
        states += 1
        link.append(0)
        length.append(length[last] + 1)
        while p >= 0 and not table[p, c]:
            table[p, c] = state
            p = link[p]
        if p >= 0:
            q = int(table[p, c])
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = states
                states += 1
                table[copy] = table[q]
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and table[p, c] == q:
                    table[p, c] = copy
                    p = link[p]
                link[q] = copy
                if state != q:
                    link[state] = copy
        last = state
    return table[:states].copy()


class Parser:
    """All languages' automata in one transition table.

    Built once. Tasks get it with the table left out, which they map from the shared file that ``publish`` wrote.
    """

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]):
        self.langs = [lang for lang, _ in samples]
        forms = [bytes([_GAP]).join(_FORM[np.frombuffer(t.encode(), np.uint8)].tobytes() for t in texts) for _, texts in samples]
        used = sorted(set(b"".join(forms)) - {_GAP})
        self.unseen, self.pad = len(used), len(used) + 1
        self.width = len(used) + 2
        self.code = np.full(256, self.unseen, np.int32)
        self.code[used] = np.arange(len(used))
        self.bits = np.array([np.log2(max(2, len(f))) for f in forms])
        tables, self.roots, base = [], [], 0
        for form in forms:
            symbols = np.where(np.frombuffer(form, np.uint8) == _GAP, -1, self.code[np.frombuffer(form, np.uint8)])
            moves = suffix_automaton(symbols.tolist(), self.width)
            step = moves * np.int32(self.width) + np.int32(base)
            step[moves == 0] = -1
            step[:, self.pad] = base + np.arange(len(moves)) * self.width
            tables.append(step)
            self.roots.append(base)
            base += step.size
        self.table = np.concatenate([t.ravel() for t in tables]) if tables else np.zeros(0, np.int32)
        # Where a symbol leads from the start; a symbol that no phrase holds leads back to it.
        first = [np.where(t[0] < 0, r, t[0]) for t, r in zip(tables, self.roots)]
        self.first = np.stack(first).astype(np.int32) if first else np.zeros((0, self.width), np.int32)

    def publish(self, spark: SparkSession) -> Parser:
        self.shared = SharedArray(spark, self.table, "automata")
        return self

    def __getstate__(self) -> dict:
        return {**self.__dict__, "table": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, table=state["shared"].open())

    def entropies(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits per byte of each text (rows) against each language (columns)."""
        sizes = np.diff(offsets)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = offsets[:-1][owner] + inner * BLOCK
        stop = np.minimum(start + BLOCK, offsets[1:][owner])
        at = start[None, :] + np.arange(BLOCK)[:, None]
        codes = np.full(at.shape, self.pad, np.int32)
        inside = at < stop[None, :]
        codes[inside] = self.code[_FORM[data]][at[inside]]
        langs = len(self.langs)
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(owner), axis=1)
        breaks = np.zeros((langs, len(owner)), np.int32)
        for row in codes:
            following = self.table.take(state + row)
            stuck = following < 0
            breaks += stuck
            state = np.where(stuck, self.first[:, row], following)
        phrases = np.stack([np.bincount(owner, b + 1, len(sizes)) for b in breaks])
        return (phrases * self.bits[:, None] / np.maximum(sizes, 1)).T


def _verdicts(texts: pa.Array, parser: Parser) -> list[pa.Array]:
    """Language and score of each text."""
    names = np.array([*parser.langs, UNKNOWN], object)
    best, score = np.full(len(texts), len(parser.langs)), np.zeros(len(texts))
    if parser.langs:
        for first, last, data, offsets in tb.slices(texts):
            cost = parser.entropies(data, offsets)
            order = np.argsort(cost, axis=1, kind="stable")
            best[first:last] = order[:, 0]
            if len(parser.langs) > 1:
                low, next_low = np.take_along_axis(cost, order[:, :2], 1).T
                score[first:last] = 1 - low / np.maximum(next_low, 1e-12)
            else:
                score[first:last] = 1.0
        for k, t in enumerate(texts):
            t = t.as_py()
            if not t or not _LETTER.search(t):
                best[k], score[k] = len(parser.langs), 0.0
    return [pa.array(names[best], pa.string()), pa.array(np.clip(score, 0, 1))]


def language_samples(labelled: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang"):
    """((language, excerpts), ...) of at most SAMPLE_ROWS excerpts each."""
    rows = labelled.filter(F.col(lang).isNotNull() & (F.col(text) != ""))
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key).cast("string")).alias("draw"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    share = F.least(F.lit(1.0), F.lit(2.0 * SAMPLE_ROWS + 10) / F.col("n"))
    limits = counts.select("lang", (F.lit(-(2.0**63)) + share * 2.0**64).alias("limit"))
    rows = rows.join(F.broadcast(limits), "lang")  # LANGUAGES rows at most
    room = F.greatest(F.char_length("text") - EXCERPT, F.lit(0)) + 1
    drawn = rows.filter("draw <= limit").select(
        "lang", "draw", F.substring("text", F.pmod("draw", room).cast("int") + 1, F.lit(EXCERPT)).alias("text")
    )
    held: dict[str, dict[str, None]] = {}
    for r in sorted(drawn.collect(), key=lambda r: (r["draw"], r["text"])):
        texts = held.setdefault(r["lang"], {})
        if len(texts) < SAMPLE_ROWS:
            texts[r["text"]] = None
    return tuple((name, tuple(held[name])) for name in sorted(held))


def language_of(spark: SparkSession, samples) -> Callable[[Column], Column]:
    """A column function from text to lang_pred and score. Texts go to Python, nothing but verdicts comes back."""
    parser = Parser(samples).publish(spark)

    def verdicts(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.StructArray.from_arrays(_verdicts(batch, parser), ["lang_pred", "score"])

    verdicts.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Not pushed below other steps, which would ask twice.
    return F.arrow_udf(verdicts, "lang_pred string, score double").asNondeterministic()


def predict_language(docs: DataFrame, samples, *, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` with lang_pred and score, the relative gap between the two best entropies."""
    verdict = language_of(text_batches(docs), samples)
    return docs.select(*keys, verdict(F.col(text)).alias("verdict")).select(*keys, "verdict.lang_pred", "verdict.score")


def keep_identified(docs: DataFrame, samples, *, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, all columns, that are in some known language."""
    verdict = language_of(text_batches(docs), samples)
    found = packed(docs).withColumn("verdict", verdict(F.col("text")))
    known = (F.col("verdict.lang_pred") != UNKNOWN) & (F.col("verdict.score") >= min_score)
    return unpacked(found.filter(known), docs.columns)


def held_out(doc_id):
    return in_fold(doc_id, 4, 2)


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    samples = language_samples(docs.filter(~held_out(F.col("doc_id"))))
    found = predict_language(docs, samples, keys=["doc_id"])
    return found.withColumn("held_out", held_out(F.col("doc_id")))
