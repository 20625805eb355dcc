"""Best-first collocations against a count of every phrase."""

import random
import re
from collections import Counter

import pytest

from bikeflow.llm import collocations

SCHEMA = "doc_id long, text string, lang string"


def words_of(piece):
    return re.findall(r"[^\x20\x09]+", piece)


def brute(rows, least, top, inside):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        f = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = words_of(piece)
            totals["und" if lang is None else lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    f[tuple(w[i : i + size])] += 1
    found = []
    for lang, f in counts.items():
        wanted = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in wanted.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and p in {q[:2], q[1:]} for q, b in wanted.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def corpus(seed):
    rng = random.Random(seed)
    common = [f"w{k}" for k in range(30)]
    phrases = [[f"p{k}", f"q{k}", f"r{k % 3}"][: rng.choice([2, 3])] for k in range(40)]
    rows = []
    for k in range(160):
        text = []
        for _ in range(rng.randrange(30)):
            part = rng.choice(phrases) if rng.random() < 0.5 else [rng.choice(common)]
            text.append((" ".join(part)).upper() if rng.random() < 0.2 else " ".join(part))
            text.append(rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n"]))
        rows.append((k, "".join(text), rng.choice(["aa", "bb", None])))
    # A passage in many copies: phrases with one score and one count, more than are listed.
    passage = " ".join(f"c{k}" for k in range(25)) + " é ß\x0bnew"
    rows += [(1000 + k, passage, "bb") for k in range(12)]
    return [*rows, (7, None, "aa"), (7, "", None), (8, " .,;", "cc"), (9, "alone", "dd"), (10, "a a a a a a a a a a a a a", "ee")]


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in collocations.collocations(docs, **options).select(*columns).collect())


@pytest.mark.parametrize("top", [3, 17, 2000])
def test_equals_counting_all_phrases(spark, top):
    rows = corpus(top)
    want = brute(rows, 10, top, 50)
    assert len(want) > 6
    assert run(spark, rows, top=top) == want


def test_rounds_go_on_until_the_last_place_is_settled(spark, monkeypatch):
    """The best pairs all fall to longer phrases of low scores, so the first round settles nothing."""
    calls = []
    real = collocations.thresholds
    monkeypatch.setattr(collocations, "thresholds", lambda *a: calls.append(a) or real(*a))
    rows = [(k, f"a{k} b{k} c. " * 12 + f"x{k} y, " * (10 + k) + "c. y. " * 20 * k, "aa") for k in range(30)]
    assert run(spark, rows, top=4) == brute(rows, 10, 4, 50)
    assert len(calls) > 1


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(3_000_000_000, 3_000_000_007, 3_000_000_011)], "a long, l long, r long")
    a, l, r, score = row.select("*", collocations._score("a", "l", "r")).first()
    assert score == 1_000_000 * a * a // (l * r)


def test_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame(corpus(1), SCHEMA)
    assert collocations.collocations(docs.limit(0)).count() == 0
    for name in ("key", "lang_key", "k1", "f", "n", "phrase"):
        docs = docs.withColumn(name, docs.doc_id)
    assert collocations.collocations(docs).count() == len(brute(corpus(1), 10, 2000, 50))


def test_a_hot_pair(spark):
    rows = [(k, "hot pair " * 400 + f"x{k}", "aa") for k in range(50)]
    assert run(spark, rows) == brute(rows, 10, 2000, 50)
