import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gridlens.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k=20):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    total, size = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in held:
            m = 75 + 25 * sum(c.values()) * total // size
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, i, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def search(docs, items, **kw):
    return sorted(map(tuple, L.ranked_search(docs, items, **kw).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_search_equals_brute_force_with_ties_and_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Éa", "éa", "naïve", "日本語", "A1", "a1"]
    docs = [(rng.choice([None, *range(200)]), " ".join(rng.choices(words, k=rng.randint(0, 12)))) for _ in range(250)]
    table = spark.createDataFrame(docs, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    docs += [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(i, " ".join(rng.choices([*words, "unknown"], k=rng.randint(1, 9)))) for i in range(30)]
    items += [(3, "w1 w1 w2"), (None, "w5, W5!"), (50, None), (51, ""), (52, "...")]
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    want = brute_force(docs, items)
    assert search(table, asked) == want
    monkeypatch.setattr(L, "GROUP_TERMS", 20)  # several groups of items
    assert search(table, asked, block_docs=16, leaf_docs=2) == want
    assert search(no_docs, asked) == [] == search(table, asked.where("false"))


def test_trees_prune_and_stay_exact():
    rng = np.random.default_rng(1)
    kinds = [rng.choice(4000, 40, replace=False) for _ in range(40)]
    rows = [np.sort(rng.choice(kinds[rng.integers(40)], 36, replace=False)) for _ in range(2000)]
    starts = np.cumsum([0, *map(len, rows)])
    names, values = np.concatenate(rows), rng.integers(400_000, 500_000, starts[-1])
    tree = L.BallTree(starts, names, values, np.ones(4000))
    opened = 0
    for _ in range(20):
        query, weights = np.sort(kinds[rng.integers(40)][:20]), rng.integers(1, 9000, 20)
        dense = np.zeros(4000, dtype=np.int64)
        dense[query] = weights
        exact = np.add.reduceat(values * dense[names], starts[:-1])
        best = L._Best(20)
        for where, scores in tree.search(query, weights, best.least):
            assert (scores == exact[where]).all()
            opened += len(where)
            best.add(scores, where, np.zeros(len(where), dtype=bool))
        assert best.scores.tolist() == np.sort(exact[exact > 0])[::-1][:20].tolist()
    assert opened < 0.3 * 20 * len(rows)


def test_lengths_beyond_64_bits_are_divided_exactly():
    tf, n = np.array([3, 1]), np.array([10**12, 5])
    want = [10**9 * t // (1000 * t + 12 * (75 + 25 * int(x) * 10**10 // 10**15)) for t, x in zip(tf.tolist(), n.tolist())]
    assert L.frequencies(tf, n, 10**10, 10**15).tolist() == want


def test_given_benchmark_finds_planted_passages(spark, sample_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = search(sample_docs, items)
    rows = [(r.doc_id, r.text) for r in sample_docs.collect()]
    assert got == brute_force(rows, [(r.item_id, r.text) for r in items.select("item_id", "text").collect()])
    assert sample_docs.where(F.col("text").isNotNull()).count() > 20 and got
