"""Token counts through a digest cache.

A text's digest and the tokenizer's digest together name a count. Counts already stored are joined;
of the rest each distinct text is encoded once, and its count is appended to the store. The store is
a Parquet folder that only grows, so a run that is repeated after a failure finds what was written.

Only digests go through the grouping; the one shuffle of texts moves the chosen representative's
row towards its id. Within a task, counts of words are remembered: no piece of the vocabulary has a
space behind another character, so a text's pieces are those of its words with the spaces before them.

Defined cases: a null text counts as empty, with zero tokens; equal texts, in any number, are encoded
once; documents with equal ids each keep their row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.llm.tables import table, text_batches
from bikeflow.session import work_folder

MODEL = "piece_bpe_32k.model"
OVER_LIMIT = 4096
# Words whose counts a task remembers before it starts anew; this bounds memory, not results.
REMEMBERED_WORDS = 1_000_000
STORE_SCHEMA = "digest string, tokenizer string, n_tokens long"

_CHUNK = re.compile(" +[^ ]*")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCounts(dict):
    """word -> tokens of the word with one space before it."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        # Splitting at spaces is exact only if no piece crosses from a character into a space.
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.splits = not any("▁" in p.lstrip("▁") for p in pieces) and len(self.model.encode("")) == 0

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        n = self[word] = len(self.model.encode(word)) if word else 1
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.splits:
            return len(self.model.encode(text, num_threads=1))
        text = text.replace("▁", " ")
        words = text.split(" ")
        if "" in words:  # runs of spaces, and spaces at either end
            words = [c[1:] for c in _CHUNK.findall(" " + text)]
        return sum(map(self.__getitem__, words))


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counts = PieceCounts(path)
    for batch in batches:
        n = [counts.count(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])


def _stored(spark: SparkSession, store: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(STORE_SCHEMA).parquet(store) if there else spark.createDataFrame([], STORE_SCHEMA)


def count_tokens(docs: DataFrame, store: str, *, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes and n_tokens of each row; the store is extended with texts not yet in it."""
    spark = text_batches(docs)
    with open(model, "rb") as f:
        version = hashlib.sha256(f.read()).hexdigest()
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), content.alias("text"))
    digests = rows.select("key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("digest"))
    known = _stored(spark, store).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    # One row of each digest without a count; ids may repeat, so the digest is tested again below.
    chosen = digests.groupBy("digest").agg(F.min("key").alias("key")).join(known, "digest", "left_anti")
    texts = rows.withColumn("own", F.sha2("text", 256)).join(chosen.hint("shuffle_hash"), rows["key"].eqNullSafe(chosen["key"]))
    texts = texts.filter(F.col("own") == F.col("digest")).select("digest", "text")
    fresh = texts.mapInArrow(lambda it: _encode(it, model), "digest string, n_tokens long")
    fresh.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(store)

    counts = _stored(spark, store).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return digests.join(counts, "digest").select(F.col("key").alias(key), "n_bytes", "n_tokens")


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = count_tokens(table(spark, sf, "documents"), work_folder(spark, "token-counts"), model=tokenizer_path(MODEL))
    return counted.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)
