"""Decontamination, token counts and packing against brute force, on awkward rows."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from bikeflow.llm import decontaminate, packing, token_counts
from bikeflow.session import work_folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

TEXTS = [
    None, "", " ", "\n\n", "one", "One two, three! four", "a  b   c", " lead and trail ", "tab\tand\nline\r\n",
    "don't they'll I'VE 12345 ½ déjà-vu Straße ñandú ÀÉÎ", "漢字 かな 한글 العربية", "end<|endoftext|>of text <s>x</s>",
    "▁under▁score ▁", "zero​width  nbsp\x00nul \x85next", "word " * 3000, "x" * 20000, "same text", "same text",
    "ﬁ ligature é combining", "🙂🙃 emoji", "\ttab  two  spaces\n \n", "'s 't'lls", "a b",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(3, "repeated id", 1), (None, "no id", 2), (None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words long").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_words long")


def brute_hits(text, items, window=13):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hit, found = set(), set()
    for item, body in items:
        pattern = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in body or ""))
        n = min(window, len(pattern))
        windows = {tuple(pattern[i : i + n]) for i in range(len(pattern) - n + 1)} if n else set()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found |= {str(item)} - {"None"}
    return len(words), len(hit), sorted(found)


def test_hits_equal_brute_force_for_any_pattern_length(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "C", "dé", "ñ", "e1", "f", "gg"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(60)] + TEXTS
    items = [(i, rng.choice([", ", " ", "\n"]).join(rng.choices(vocabulary, k=k))) for i, k in enumerate([1, 2, 3, 4, 4, 5, 6, 13, 0])]
    items += [(20, " ".join(texts[3].split()[:14])), (21, "... !"), (22, None), (None, "a"), (1, "b"), (30, "gg"), (31, "gg")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = {i: brute_hits(t, items) for i, t in enumerate(texts)}
    for limit in (1_000_000, 5):
        got = decontaminate.benchmark_hits(docs, benchmark, keys=["doc_id"], max_pattern_words=limit).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in got} == expected


def test_rows_of_equal_and_null_ids_stay_apart_with_several_pattern_sets(spark):
    rows = [(1, "one two three"), (1, "four five"), (None, "one two"), (None, "six"), (2, "one two three"), (2, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    items = [(1, "one two"), (2, "two three"), (3, "five"), (4, "unseen words here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(i), *brute_hits(t, items)) for i, t in rows)
    for limit in (1_000_000, 1):
        got = decontaminate.benchmark_hits(docs, benchmark, keys=["doc_id"], max_pattern_words=limit).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got) == want
        kept = decontaminate.drop_contaminated(docs, benchmark, max_pattern_words=limit).collect()
        assert [tuple(r) for r in kept] == [(None, "six")]


def test_an_item_without_an_id_is_a_pattern(spark):
    words = " ".join(f"w{k}" for k in range(13))
    benchmark = spark.createDataFrame([(None, words), (None, words), (4, "other words")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a {words} b"), (2, "w0 w1")], "doc_id long, text string")
    got = decontaminate.benchmark_hits(docs, benchmark, keys=["doc_id"]).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r["items"]) for r in got] == [(15, 13, []), (2, 0, [])]
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()] == [2]


def test_many_sets_find_what_one_does(spark):
    """Twenty sets and more, built in tasks; none of them is sent to the driver."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(300)]
    items = [(k % 90, " ".join(rng.choices(words, k=20))) for k in range(100)]
    texts = [" ".join(rng.choices(words, k=50)) + " " + " ".join(rng.choice(items)[1].split()[3:18]) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    folder = work_folder(spark, "patterns-test")
    sets = decontaminate.pattern_sets(benchmark, folder, item="item_id", text="text", window=13, max_words=100)
    assert len(sets) >= 15 and all(set(s) == {"name", "lengths", "blocks"} for s in sets)
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.benchmark_hits(docs, benchmark, keys=["doc_id"], max_pattern_words=100).collect()}
    assert got == {i: brute_hits(t, items) for i, t in enumerate(texts)}


def test_clashing_names_and_empty_tables(docs, empty, spark):
    benchmark = spark.createDataFrame([(1, "one")], "item_id long, text string")
    none = benchmark.limit(0)
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()
    assert decontaminate.benchmark_hits(empty, benchmark, keys=["doc_id"]).count() == 0


def test_token_counts_and_the_cache(docs, empty, folder):
    import sentencepiece

    path = token_counts.tokenizer_path(token_counts.MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.count_tokens(docs, folder + "/cache", model=path).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in docs.collect()]
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    stored = docs.sparkSession.read.parquet(folder + "/cache")
    distinct = docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert stored.count() == distinct
    # A second run encodes only what is new.
    more = docs.union(docs.sparkSession.createDataFrame([(99, "brand new", 0)], docs.schema))
    assert token_counts.count_tokens(more, folder + "/cache", model=path).count() == docs.count() + 1
    assert docs.sparkSession.read.parquet(folder + "/cache").count() == distinct + 1
    assert token_counts.count_tokens(empty, folder + "/none", model=path).count() == 0


@pytest.mark.parametrize("ranks", [None, packing.RANKS])
def test_packing_is_an_exact_cover(docs, empty, spark, ranks):
    from tokenizers import Tokenizer

    path = token_counts.tokenizer_path(packing.MODEL)
    model = Tokenizer.from_file(path)
    rows = docs.withColumn("offset", F.monotonically_increasing_id()).withColumn("tier", F.lit("x"))
    keyed = spark.createDataFrame([(i, r.doc_id, r.text) for i, r in enumerate(rows.collect())], "row long, doc_id long, text string")
    ranks = ranks and token_counts.tokenizer_path(ranks)
    got = packing.pack(keyed.repartition(2), keys=["row", "doc_id"], model=path, ranks=ranks).collect()
    want = {r.row: model.encode(r.text or "", add_special_tokens=False).ids + [1] for r in keyed.collect()}
    pieces = {}
    for p in got:
        pieces.setdefault(p.row, []).append(p)
        ids = want[p.row][p.start : p.start + p.length]
        assert p.length == len(ids) > 0 and p.doc_tokens == len(want[p.row])
        assert p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    assert pieces.keys() == want.keys()
    for row, found in pieces.items():
        found.sort(key=lambda p: p.start)
        assert found[0].start == 0 and sum(p.length for p in found) == len(want[row])
        assert all(a.start + a.length == b.start for a, b in zip(found, found[1:]))
    sequences = {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append(p)
    padded = 0
    for found in sequences.values():
        found.sort(key=lambda p: p.offset)
        assert found[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(found, found[1:]))
        total = found[-1].offset + found[-1].length
        assert total <= 2048 and {p.sequence_tokens for p in found} == {total}
        padded += total not in (256, 512, 1024, 2048)
    assert padded <= 2  # one a task
    assert packing.pack(empty, keys=["doc_id"], model=path).count() == 0


def test_each_tier_packs_sequences_of_its_own(spark):
    """Texts of all lengths: every size of window comes up, mostly with pieces of its own tier, and nothing much is padded."""
    path = token_counts.tokenizer_path(packing.MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").coalesce(1)
    got = packing.pack(docs, keys=["doc_id"], model=path, ranks=token_counts.tokenizer_path(packing.RANKS), pool_tokens=40_000)
    pieces = got.select("sequence_id", "sequence_tokens", "tier", "length", "step_group").collect()
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    sizes = [s[0].sequence_tokens for s in sequences.values()]
    assert all(sizes.count(t) >= 8 for t in packing.TIERS)
    padding = sum(2048 - n for n in sizes if n not in packing.TIERS)
    assert padding <= 2048 and padding < 0.001 * (sum(sizes) + padding) + 2048
    for low, high in zip((0, 256, 512, 1024), packing.TIERS):
        own = [s for s in sequences.values() if s[0].sequence_tokens == high]
        assert sum(any(low < p.length <= high for p in s) for s in own) > 0.8 * len(own)
    # A step has sequences of one size.
    steps = {}
    for s in sequences.values():
        steps.setdefault(s[0].step_group, set()).add(s[0].tier)
    assert all(len(tiers) == 1 for tiers in steps.values())


def test_step_groups_are_balanced():
    sequences = [[("r", 0, b"\0" * 4 * n, n)] for n in (2000, 100, 1900, 200, 1800, 300, 1700, 400)]
    groups = {}
    for r in packing._grouped(sequences, 0, 0, 4):
        groups.setdefault(r[8], []).append(r[2] ** 2)
    cost = [sum(v) for v in groups.values()]
    assert len(cost) == 2 and {len(v) for v in groups.values()} == {4} and max(cost) < 1.2 * min(cost)


def test_both_encoders_agree_on_the_given_texts(spark):
    """The rank file is the same vocabulary: equal ids on every document of the small table."""
    path = token_counts.tokenizer_path(packing.MODEL)
    one, two = packing.Ids(path), packing.Ids(path, token_counts.tokenizer_path(packing.RANKS))
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    for text in [r.text for r in rows] + [t for t in TEXTS if t]:
        assert one.encode(text) == two.encode(text)
