"""Parity-sketch join, fuzzy lines and components against brute force."""

import random
import re

import numpy as np
import pytest

from bikeflow.llm import candidates, graph, line_dedup, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width):
    words = WORD.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def roots(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def brute(rows, width, num, den):
    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[k + 1 :]
        if x and y and den * len(x & y) >= num * len(x | y)
    ]
    return roots({i for i, _ in sets}, links)


def corpus(rng, docs=40, copies=6):
    rows = [None, "", " \t\n", "one", "one", "two words", "Two WORDS", "a b c", "a b c d"]
    for _ in range(docs):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 8, 12, 30, 60, 150, 400]))]
        rows.append(" ".join(words))
        for _ in range(rng.randrange(copies)):
            words = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                k = rng.randrange(len(words))
                words[k : k + rng.choice([0, 1])] = [f"x{rng.randrange(10**6)}"] * rng.choice([0, 1])
                words = words or ["z"]
            rows.append("  ".join(words) if rng.random() < 0.3 else " ".join(words))
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows))


@pytest.mark.parametrize("width,num,den,seed", [(3, 90, 100, 1), (5, 8, 10, 2)])
def test_components_equal_brute_force(spark, width, num, den, seed):
    rows = corpus(random.Random(seed)) + [(None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.similar_components(docs, width=width, num=num, den=den).collect()
    want = brute(rows, width, num, den)
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.component_id, r.n_shingles) == (want[r.doc_id], len(shingles(texts[r.doc_id], width)))
    assert len(set(want.values())) < len(want) - 20


def test_a_group_larger_than_a_cell_is_split_and_stays_whole(spark, monkeypatch):
    monkeypatch.setattr(candidates, "BLOCK_ROWS", 7)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(60):  # neighbours in a chain are similar, ends are not
        base[rng.randrange(200)] = f"new{k}"
        rows.append((k, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in ngram_join.similar_components(docs, width=3, num=90, den=100).collect()}
    assert got == brute(rows, 3, 90, 100) and set(got.values()) == {0}


def test_some_sketch_lane_is_equal_for_every_similar_pair():
    rng = np.random.default_rng(4)
    for size in (5, 11, 20, 60, 300, 2000):
        for num, den in ((90, 100), (8, 10)):
            for _ in range(30):
                one = np.unique(rng.integers(1, 1 << 63, size, np.uint64))
                apart = (den - num) * 2 * len(one) // (den + num)
                gone, come = rng.integers(0, apart // 2 + 1), rng.integers(0, apart // 2 + 1)
                two = np.unique(np.concatenate([one[gone:], rng.integers(1, 1 << 63, come, np.uint64)]))
                both = len(np.intersect1d(one, two))
                if den * both >= num * (len(one) + len(two) - both) and len(one) + len(two) > 2 * both:
                    a, b = (set(ngram_join.sketch_keys(s, num, den).tolist()) for s in (one, two))
                    assert a & b


def test_keep_first_keeps_one_of_each_group_and_all_columns(spark):
    long = " ".join(f"w{k}" for k in range(100))
    rows = [(3, long, 1, "x"), (7, long + " tail", 2, "y"), (9, "other text", 3, None), (None, long, 4, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id long, later_id string")
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 9]
    assert ngram_join.keep_first(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(6)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(5, 5), (200, 201), (201, 200), (200, 201)]
    rng.shuffle(links)
    edges = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r.id: r.component for r in graph.connected_components(edges).collect()}
    want = roots({n for e in links for n in e}, links)
    assert got == want
    assert graph.connected_components(edges.limit(0)).count() == 0


# -- lines ---------------------------------------------------------------------------------


def normal(line):
    return "".join(c for c in lower(line) if c.isascii() and c.isalnum() or ord(c) >= 128)


def brute_lines(rows):
    width = line_dedup.SHINGLE
    lines = [(i, n, normal(x)) for i, t in rows if t is not None for n, x in enumerate(t.split("\n"))]
    lines = sorted((i, n, x) for i, n, x in lines if x)
    texts = sorted({x for _, _, x in lines})
    sets = {x: {x[k : k + width] for k in range(len(x) - width + 1)} or {x} for x in texts}
    links = [
        (a, b)
        for k, a in enumerate(texts)
        for b in texts[k + 1 :]
        if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    ]
    group, seen, gone = roots(texts, links), set(), set()
    for i, n, x in lines:
        if group[x] in seen:
            gone.add((i, n))
        seen.add(group[x])
    return {
        i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows
    }


def test_lines_equal_brute_force(spark):
    rng = random.Random(8)
    pool = ["", " ", "***", "Ja.", "ja", "Été né à l'île", "été NÉ à l île!", "漢字の行です", "same line here", "x" * 3000]
    for _ in range(25):
        line = " ".join("".join(rng.choices("abcdefgéñ", k=rng.randint(2, 7))) for _ in range(rng.randint(12, 40)))
        pool += [line, line.upper() + "!!" if line.isascii() else line, line[:-1] + "q", line.replace(" ", "  ", 2), "z" + line[1:]]
    rows = [(k, "\n".join(rng.choices(pool, k=rng.randint(1, 6)))) for k in range(80)]
    rows += [(900, None), (901, ""), (902, "\n\n"), (903, "one\r\ntwo\r\none")]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, row string, n_dropped long")
    got = line_dedup.dedup_lines(docs.select("doc_id", "text").repartition(4))
    assert {r.doc_id: r.text for r in got.collect()} == brute_lines(rows)
    counts = {r.doc_id: (r.n_lines, r.n_dropped) for r in got.collect()}
    assert counts[900] == (0, 0) and counts[902] == (3, 0) and counts[903][0] == 3
    clash = docs.withColumnRenamed("n_dropped", "kept").withColumnRenamed("row", "numbers")
    assert line_dedup.dedup_lines(clash).select("numbers", "kept").distinct().count() == 1
    assert line_dedup.dedup_lines(docs.select("doc_id", "text").limit(0)).count() == 0


def test_repeated_rows_and_null_ids_lose_the_same_lines(spark):
    rows = [(1, "alpha beta gamma\nrest one"), (1, "alpha beta gamma\nrest one"), (None, "alpha beta gamma\nnull id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert got == [(0, "alpha beta gamma\nnull id"), (1, "rest one"), (1, "rest one")]


def test_banding_recall():
    """Signatures of lines of similarity just over 0.8 meet in some band nearly always."""
    import pyarrow as pa

    rng = np.random.default_rng(9)
    texts, pairs = [], 400
    for _ in range(pairs):
        line = rng.integers(97, 123, 300).astype(np.uint8)
        other = line.copy()
        for at in rng.choice(290, 4, replace=False):
            other[at] = 48
        texts += [line.tobytes().decode(), other.tobytes().decode()]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array(range(len(texts)), pa.int64())], ["id", "text", "row"])
    met, owner = {}, {}
    for out in line_dedup._lines(iter([batch]), line_dedup.SHINGLE, False):
        owner.update(zip(out["line"].to_pylist(), out["row"].to_pylist()))
    for out in line_dedup._lines(iter([batch]), line_dedup.SHINGLE, True):
        for key, line in zip(out["key"].to_pylist(), out["id"].to_pylist()):
            met.setdefault(key, set()).add(owner[line] // 2)
            met.setdefault((key, owner[line] // 2), []).append(line)
    found = {k[1] for k, v in met.items() if isinstance(k, tuple) and len(set(v)) == 2}
    assert len(found) >= 0.97 * pairs
