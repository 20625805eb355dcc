"""Flat token files: an exact round trip, and ids equal to the library's."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bikeflow.llm import tables, token_files
from bikeflow.llm.token_counts import tokenizer_path
from bikeflow.session import work_folder

SF = "/root/testdata/sf0.001"
PATH = tokenizer_path(token_files.MODEL)
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


def library(model, text):
    return [*model.encode(text or "", add_special_tokens=False).ids, token_files.END_TOKEN]


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_query_equals_the_library(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = token_files.op12_token_binary(spark, SF)
    assert dict(found.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    start, want = 0, []
    for r in sorted(docs):
        ids = library(model, r.text)
        want.append((r.doc_id, start, len(ids), digest(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in found.collect()) == want


def test_any_text_is_encoded_as_by_the_library(model):
    rng = random.Random(1)
    alphabet = "aZȺȾé ßİıŉ\t\n\r\x0b\x1c\x85  ́ǆ中🙂'sdt'lL1230½<|>/_-​ẞ"
    texts = ["", " ", "<|endoftext|>", "a<|startoftext|> b", "it's 'S don't'LL", "x" * 5000, "é" * 300 + " tail", "é ́a"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]
    encoder = token_files.Encoder(PATH)
    assert encoder.plain
    for text in texts:
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == library(model, text)


def test_all_words_of_a_table_have_the_library_s_ids(spark, model):
    """Merges by ranks of joined pieces, and by listed pairs, might differ; they do not on these words."""
    words = sorted({w for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect() for w in (r.text or "").split()})
    encoder = token_files.Encoder(PATH)
    sure = model.encode_batch(words, add_special_tokens=False)
    assert all(np.frombuffer(encoder.encode(w), encoder.kind).tolist()[:-1] == e.ids for w, e in zip(words, sure))


def test_a_vocabulary_of_another_kind_goes_to_its_library():
    path = tokenizer_path("byte_bpe_50k.json")
    encoder, other = token_files.Encoder(path, end=None), Tokenizer.from_file(path)
    assert encoder.plain is None
    assert np.frombuffer(encoder.encode("Some text, it's one"), encoder.kind).tolist() == other.encode("Some text, it's one").ids


def test_shards_places_and_cases(spark, model):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choices(["one", "two", "Three", "4"], k=rng.randrange(30)))) for k in rng.sample(range(-500, 10**12, 10**8), 200)]
    rows += [(None, "no id"), (None, None), (7, None), (7, "seven"), (7, "seven"), (7, "other"), (8, "long " * 3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(9)
    for clash in ("key", "tie", "turn", "ids", "start", "task"):
        docs = docs.withColumn(clash, F.lit(1))
    folder = work_folder(spark, "token-files-test")
    files = token_files.write_tokens(docs, folder, model=PATH, shard_tokens=100)
    (folder_system, path) = tables.shared_place(folder)
    with folder_system.open_output_stream(f"{path}/000000-0000-left-by-a-lost-task.ids") as out:
        out.write(b"123")
    found = sorted(files.documents(with_ids=True).collect(), key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    keys = [r.doc_id for r in found]
    assert keys[:2] == [None, None] and keys[2:] == sorted(keys[2:])
    got = sorted((str(r.doc_id), r.ids, r.n_tokens, r.ids_crc32) for r in found)
    want = [(str(i), library(model, t)) for i, t in rows]
    assert got == sorted((i, ids, len(ids), digest(ids)) for i, ids in want)

    # The files by themselves: flat numbers, offsets in ids, bases that add up.
    shards = sorted(files.manifest.collect(), key=lambda r: r.first_token)
    assert len(shards) > 5 and files.kind == "<u2"
    assert [r.first_doc for r in shards] == np.cumsum([0, *(r.docs for r in shards)])[:-1].tolist()
    flat = np.concatenate([np.fromfile(f"{path}/{r['name']}.ids", "<u2") for r in shards])
    assert flat.tolist() == [i for r in found for i in r.ids]
    one = token_files.Shard(folder, shards[3]["name"], files.kind)
    assert isinstance(one.ids, np.memmap) and one[len(one) - 1].tolist() == found[shards[3].first_doc + len(one) - 1].ids
    again = token_files.open_tokens(spark, folder, files.kind)
    assert again.documents().count() == len(rows)


def test_one_id_on_most_rows_is_dealt_out(spark):
    rows = [(1, "same text")] * 600 + [(k, f"text {k}") for k in range(2, 300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = token_files.write_tokens(docs, work_folder(spark, "token-files-test"), model=PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = [r.docs for r in files.manifest.collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 500


def test_a_missing_or_cut_file_is_an_error(spark):
    folder = work_folder(spark, "token-files-test")
    files = token_files.write_tokens(spark.createDataFrame([(1, "a b c")], SCHEMA), folder, model=PATH)
    system, path = tables.shared_place(folder)
    with system.open_output_stream(f"{path}/{files.manifest.first()['name']}.ids") as out:
        out.write(b"\1\0")
    with pytest.raises(Exception, match="manifest names"):
        files.documents().collect()


def test_empty_table(spark):
    files = token_files.write_tokens(spark.createDataFrame([], SCHEMA), work_folder(spark, "token-files-test"), model=PATH)
    assert files.documents().collect() == []
