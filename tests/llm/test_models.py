"""Language identification and toxicity: held-out accuracy, hand-made parses, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bikeflow.llm import language_id, toxicity
from bikeflow.llm import textbytes as tb

SF = "/root/testdata/sf0.1"


def test_parses_equal_the_definition():
    import random

    rng = random.Random(1)
    samples = tuple((lang, tuple("".join(rng.choices(letters + " ", k=200)) for _ in range(3))) for lang, letters in (("a", "abcd"), ("b", "cdéf")))
    texts = ["".join(rng.choices("abcdefé xyZ9", k=rng.randint(1, 300))) for _ in range(50)]
    parser = language_id.Parser(samples)
    form = lambda t: language_id._FORM[np.frombuffer(t.encode(), np.uint8)].tobytes()
    raw = [form(t) for t in texts]
    data = np.frombuffer(b"".join(t.encode() for t in texts), np.uint8)
    offsets = np.cumsum([0, *(len(t) for t in raw)])
    cost = parser.entropies(data, offsets)
    for row, t in zip(cost, raw):
        for lang, (_, sample) in enumerate(samples):
            held = [form(s) for s in sample]
            blocks = [t[k : k + language_id.BLOCK] for k in range(0, len(t), language_id.BLOCK)]
            unknown = sum(greedy_breaks(b, held) for b in blocks)
            assert row[lang] == pytest.approx(unknown * parser.bits[lang] / len(t))


def greedy_breaks(block, sample):
    """One phrase, and one more where a match ends; a symbol no sample holds ends one by itself."""
    known = set(b"".join(sample))
    phrases, at, n = 1, 0, 0
    while at + n < len(block):
        if any(block[at : at + n + 1] in s for s in sample):
            n += 1
            continue
        phrases += 1
        at, n = at + n, 0
        if block[at] not in known:
            at += 1
    return phrases


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.op4_language_id(spark, SF).join(docs, "doc_id")
    right = (F.col("lang_pred") == F.col("lang")).cast("double")
    found = got.filter("held_out").agg(F.avg(right).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert found["right"] > 0.99 and 0 <= found["low"] <= found["high"] <= 1


def test_language_of_awkward_rows(spark):
    samples = (("de", ("der die das und nicht mit einem haus",)), ("en", ("the and with house not of that",)))
    texts = [None, "", " 123 !?", "🙂 …", "the house and that", "Der und die", "é", "the " * 50_000, "漢字"]
    docs = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate(texts)], "doc_id long, text string, score double")
    got = {r.doc_id: r for r in language_id.predict_language(docs, samples, keys=["doc_id"]).collect()}
    assert [got[k].lang_pred for k in range(4)] == ["und"] * 4 and got[0].score == 0
    assert got[4].lang_pred == got[7].lang_pred == "en" and got[5].lang_pred == "de"
    assert got[6].lang_pred in ("de", "en") and all(0 <= r.score <= 1 for r in got.values())
    assert language_id.predict_language(docs, (), keys=["doc_id"]).filter("lang_pred != 'und'").count() == 0
    assert language_id.predict_language(docs, samples[:1], keys=["doc_id"]).filter("lang_pred = 'de'").count() == 5
    kept = language_id.keep_identified(docs, samples)
    assert kept.columns == docs.columns and kept.filter("doc_id in (4, 5, 7)").count() == 3
    assert language_id.predict_language(docs.limit(0), samples, keys=["doc_id"]).count() == 0


def test_samples_are_bounded_and_distinct(spark):
    rows = [(k, f"text number {k % 90} of many", "en") for k in range(3000)] + [(k, "copy", "de") for k in range(3000, 6000)]
    rows += [(None, "no id", "fr"), (7000, None, "es"), (7001, "", "es"), (7002, "no label", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    samples = dict(language_id.language_samples(docs))
    assert sorted(samples) == ["de", "en", "fr"] and len(samples["en"]) == language_id.SAMPLE_ROWS
    assert samples["de"] == ("copy",) and len(set(samples["en"])) == len(samples["en"])
    assert language_id.language_samples(docs.limit(0)) == ()


def test_a_language_gives_24_excerpts(spark):
    docs = spark.createDataFrame([(k, f"text number {k} of many", "en") for k in range(500)], "doc_id long, text string, lang string")
    assert [len(texts) for _, texts in language_id.language_samples(docs)] == [24]


def test_toxicity_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.op1_toxicity(spark, SF).join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").toPandas()
    toxic, score = got.toxic.to_numpy() == 1, got.score.to_numpy()
    area = (score[toxic][:, None] > score[~toxic][None, :]).mean()
    predicted = got.predicted.to_numpy() == 1
    assert ((score >= 0.7) == predicted).all() and score.min() >= 0 and score.max() <= 1
    assert area > 0.93 and predicted[toxic].mean() > 0.7 and predicted[~toxic].mean() < 0.02


def labelled(spark, n=400):
    import random

    rng = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        words = rng.choices(["calm", "river", "stone", "green", "walk", "morning"], k=rng.randint(20, 80))
        if k % 4 == 0:
            for _ in range(3):
                words[rng.randrange(len(words))] = "vile" + rng.choice(["ness", "ly", "r", "st"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    return rows, labels


def test_toxicity_of_awkward_rows(spark):
    rows, labels = labelled(spark)
    rows += [(1000, None), (1001, ""), (1002, "calm vileish vileful river vileton stone walk"), (1003, "calm stone"), (1003, "calm stone"), (None, "calm"), (1004, "é漢🙂 " * 5000)]
    labels += [(0, 0), (1, None), (5000, 1), (None, 1), (4, 1)]
    docs = spark.createDataFrame([(i, t, 3, 0.1) for i, t in rows], "doc_id long, text string, toxic long, score double")
    marks = spark.createDataFrame([(i, t, "x") for i, t in labels], "doc_id long, toxic int, text string")
    got = toxicity.score_toxicity(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[1000] == score[1001] < 0.7
    assert score[1002] > 0.3 > 3 * score[1003]  # unseen forms of a toxic stem
    assert toxicity.score_toxicity(docs, marks.limit(0)).select("score").distinct().collect()[0][0] == 0.5
    assert toxicity.score_toxicity(docs, marks.filter("toxic = 0")).select("score").distinct().count() == 1
    assert toxicity.score_toxicity(docs.limit(0), marks).count() == 0


def test_shared_backoff_is_a_distribution(spark):
    """Over all bytes, the lower-order estimates after a context sum to one."""
    wide, _ = toxicity.spaced(np.frombuffer(b"abab abc bcd", np.uint8), np.array([0, 12]))
    gram, n = np.unique(toxicity.grams(wide), return_counts=True)
    counted = spark.createDataFrame([(int(g), int(c)) for g, c in zip(gram, n)], "gram long, n long")
    p = {r.gram: r.p for r in toxicity._shared(counted).collect()}
    by_context = {}
    for g, value in p.items():
        by_context.setdefault(g >> 8, []).append(value)
    assert all(0 < sum(v) <= 1 + 1e-9 for v in by_context.values()) and len(p) > 5


def test_features_equal_the_definition():
    import pyarrow as pa

    class Table:
        """Half of all keys, each with a number of its own."""

        def __init__(self, seed):
            self.seed = np.uint64(seed)

        def get(self, keys):
            h = tb.mix(keys + self.seed)
            return np.where(h & np.uint64(1) == 1, np.nan, (h >> np.uint64(40)).astype(np.float64) / 2**22 - 2)

    tables = (Table(5), Table(77))
    texts = ["", None, "A", "hello World 7x", "  two  spaces ", "é" * 10]

    def ratio(word, k):
        gram = int.from_bytes((b" " * toxicity.ORDER + word[: k + 1])[-toxicity.ORDER :])
        value = tables[0].get(np.array([gram], np.uint64))[0]
        return np.nan_to_num(tables[1].get(np.array([gram >> 8], np.uint64))[0]) if np.isnan(value) else value

    got = toxicity.features(pa.array(texts), tables)
    for row, t in zip(got, texts):
        form = toxicity._FORM[np.frombuffer((t or "").encode(), np.uint8)].tobytes()
        words = [sum(ratio(w + b" ", k) for k in range(len(w) + 1)) for w in form.split(b" ") if w]
        best = sorted(words)[-3:]
        assert row[1] == pytest.approx(max(words, default=0), abs=1e-4)
        assert row[2] == pytest.approx(sum(best) / 3, abs=1e-4)


def kneser_ney(counted, order=toxicity.ORDER, d=toxicity.DISCOUNT):
    """Log ratios by n-gram and by context, from the definition: {(toxic, gram): n} to two dicts."""
    from math import exp, log

    totals = {c: sum(n for (k, _), n in counted.items() if k == c) for c in (0, 1)}
    thin = {1: min(1.0, totals[0] / totals[1]), 0: min(1.0, totals[1] / totals[0])}
    grams = {g for _, g in counted}
    n = {(c, g): counted.get((c, g), 0) * thin[c] for c in (0, 1) for g in grams}
    seen = {k: (float(v > 0) if thin[k[0]] == 1 else 1 - exp(-v)) for k, v in n.items()}
    # Shared lower orders: how many different bytes stand before each shorter n-gram.
    levels, below = {}, grams
    for k in range(order - 1, 0, -1):
        level = {}
        for g in below:
            level[g[-k:]] = level.get(g[-k:], 0) + 1
        levels[k], below = level, set(level)

    def lower(g):
        if not g:
            return 1 / 256
        level = levels[len(g)]
        same = [x for x in level if x[:-1] == g[:-1]]
        return (level[g] - d + d * len(same) * lower(g[1:])) / sum(level[x] for x in same)

    by_gram, by_context = {}, {}
    for context in {g[:-1] for g in grams}:
        same = [g for g in grams if g[:-1] == context]
        all_of = {c: sum(n[c, g] for g in same) for c in (0, 1)}
        gamma = {c: d * sum(seen[c, g] for g in same) / all_of[c] if all_of[c] else 1.0 for c in (0, 1)}
        by_context[context] = log(gamma[1] / gamma[0])
        for g in same:
            own = {c: (n[c, g] - d * seen[c, g]) / all_of[c] if all_of[c] else 0.0 for c in (0, 1)}
            p = lower(g[1:])
            by_gram[g] = log((own[1] + gamma[1] * p) / (own[0] + gamma[0] * p))
    return by_gram, by_context


def test_model_equals_the_definition_of_kneser_ney(spark):
    """Counts, thinning, shared backoff and look-ups against a direct computation on a few hundred texts."""
    rows, labels = labelled(spark, 240)
    mark = dict(labels)
    counted = {}
    for i, t in rows:
        for word in toxicity._FORM[np.frombuffer(t.encode(), np.uint8)].tobytes().split(b" "):
            for k in range(len(word) + 1) if word else ():
                gram = (b" " * toxicity.ORDER + word + b" ")[: toxicity.ORDER + k + 1][-toxicity.ORDER :]
                counted[mark[i], gram] = counted.get((mark[i], gram), 0) + 1
    docs = spark.createDataFrame([(mark[i], t) for i, t in rows], "toxic int, text string").repartition(3)
    raw = docs.mapInArrow(toxicity._count, "gram long, toxic long, n long").groupBy("toxic", "gram").agg(F.sum("n").alias("n"))
    found = {(r.toxic, (r.gram % 2**48).to_bytes(6)): r.n for r in raw.collect()}
    # Between and around words stand n-grams of spaces, which the definition leaves out.
    spaces = b" " * toxicity.ORDER
    assert {k: n for k, n in found.items() if k[1] != spaces} == counted
    by_gram, by_context = kneser_ney(found)
    tables = [t.opened() for t in toxicity.model_of(docs)]
    for table, want in zip(tables, (by_gram, by_context)):
        keys = np.array([int.from_bytes(g) for g in want], np.uint64)
        assert np.abs(table.get(keys) - np.array(list(want.values()))).max() < 1e-9
        strange = np.setdiff1d(np.random.default_rng(4).integers(0, 2**48, 5000, np.uint64), keys)
        assert np.isnan(table.get(strange)).all()


@pytest.mark.parametrize("part_keys", [10**9, 100])
def test_shared_tables_hold_what_they_were_given(spark, part_keys):
    from bikeflow.llm.lookup import SharedTable

    rng = np.random.default_rng(6)
    keys = np.unique(np.concatenate([rng.integers(-(2**63), 2**63 - 1, 1500), np.arange(-3, 4)]))
    values = rng.normal(size=len(keys))
    frame = spark.createDataFrame(list(zip(keys.tolist(), values.tolist())), "key long, value double").repartition(5)
    table = SharedTable(frame, "test-table", part_keys).opened()
    assert len(table.parts) == (1 if part_keys > 10**6 else 16)
    assert (table.get(keys.view(np.uint64)) == values).all()
    assert np.isnan(table.get(np.setdiff1d(rng.integers(0, 2**63 - 1, 3000), keys).view(np.uint64))).all()
    assert np.isnan(SharedTable(frame.limit(0), "test-table").opened().get(keys.view(np.uint64))).all()


def test_in_fold_matches_crc(spark):
    import zlib

    frame = spark.createDataFrame([(k,) for k in [*range(50), None]], "doc_id long")
    got = {r.doc_id: r.h for r in frame.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()}
    assert got.pop(None) is False
    assert got == {k: zlib.crc32(str(k).encode()) % 3 == 1 for k in range(50)}


def test_words_of_batches_equal_a_split():
    texts = ["", "a", "ab  c", " x y ", "", "é ñ", "end"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, ends, before = tb.word_bounds(data, offsets, tb.byte_class((0x21, 0xFF)))
    raw = data.tobytes()
    for k, t in enumerate(texts):
        assert [raw[a:b].decode() for a, b in zip(starts[before[k] : before[k + 1]], ends[before[k] : before[k + 1]])] == t.split()
    hashes = tb.span_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len({w for t in texts for w in t.split()})
