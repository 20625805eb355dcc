"""Every registered query of the subpackage on the small tables, and the pipeline's stages."""

import compare
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bikeflow.llm import registry

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op4_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5_benchmark_decontamination": {
        "doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"
    },
    "op7_packing": {
        "doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    },
    "op8_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op13_phrase_collocations": {
        "lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"
    },
    "op10_exact_topk_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    kinds = dict(got.dtypes)
    assert all(kinds[c] == t for c, t in COLUMNS.get(name, {}).items())
    found = got.toArrow()
    assert found.num_rows
    if name in registry.SQL:
        assert compare.compare(found, duck.sql(registry.SQL[name]).to_arrow_table()) is None


def test_stages_keep_the_columns_and_act_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [(10**6, None, "en", "s", None), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, "12 34", None, None, 5)], docs.schema
    )
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    extra = extra.union(spark.createDataFrame([(10**6 + 3, item, "en", "s", len(item))], docs.schema))
    now = docs.union(extra)
    names = [n for n, _ in corpus_pipeline.STAGES]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF)
        assert out.columns == docs.columns
        now = spark.createDataFrame(out.collect(), docs.schema)
        kept[name] = {r.doc_id for r in now.collect()}
    assert not kept[names[0]] & {10**6, 10**6 + 1, 10**6 + 2} and len(kept[names[0]]) >= docs.count()
    lines = [x for r in now.collect() for x in set((r.text or "").split("\n"))]
    assert all(r.n_chars == len(r.text) for r in now.collect())
    assert kept[names[3]] < kept[names[2]] <= kept[names[1]] <= kept[names[0]]
    assert 10**6 + 3 not in kept[names[3]] and len(lines) > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept[names[3]]


def test_stages_equal_brute_force(spark):
    """Lines, near copies and benchmark passages on the small table, each stage on what the one before kept."""
    from test_pairs import brute, brute_lines
    from test_scans import brute_hits

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    now = stages["line dedup"](spark, docs, SF).collect()
    want = {i: t for i, t in brute_lines(rows).items()}
    kept = {r.doc_id: r.text for r in now}
    assert all(kept[i] == want[i] for i in kept)
    assert all(not want[i].strip() for i in want.keys() - kept.keys())

    now = stages["n-gram Jaccard join"](spark, spark.createDataFrame(now, docs.schema), SF).collect()
    group = brute(list(kept.items()), 5, 8, 10)
    assert {r.doc_id for r in now} == set(group.values())

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    left = stages["benchmark decontamination"](spark, spark.createDataFrame(now, docs.schema), SF)
    hits = {r.doc_id: brute_hits(r.text, items) for r in now}
    clean = {i for i, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)}
    assert {r.doc_id for r in left.collect()} == clean


def test_run_equals_its_stages(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.agg(F.sum("length")).first()[0] > 0 and corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark):
    now = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
        assert now.count() == 0


def test_columns_named_like_the_operators_own_pass_through_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["n_dropped", "n_lines", "row", "numbers", "verdict", "hits", "n_words", "n_hit", "items", "lang_pred", "score", "id", "key", "group"]
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(k))
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns
        assert [tuple(r) for r in now.select(*names).distinct().collect()] == [tuple(range(len(names)))]
    assert corpus_pipeline.STAGES[-1][1](spark, now, SF).count()
