import random

import numpy as np
import pytest

from gridlens.llm import neardup
from gridlens.llm.components import connected_components
from gridlens.llm.neardup import near_duplicates


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute(docs, size, percent):
    """(id -> shingle count, id -> smallest id reachable), from all pairs."""
    sets = [(d, shingles(t, size)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if both and 100 * both >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: len(s) for d, s in sets}, {d: root(d) for d, _ in docs}


def families(seed, n_words):
    """Texts in families whose members differ from each other by a few to many words."""
    rng = random.Random(seed)
    docs = []
    for _ in range(12):
        base = [f"t{rng.randint(0, 400)}" for _ in range(n_words)]
        for _ in range(rng.randint(1, 12)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, n_words // 25))):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 9999)}"
            docs.append(" ".join(words).title() if rng.random() < 0.2 else " ".join(words))
    rng.shuffle(docs)
    return list(enumerate(docs))


def same(spark, docs, size=4):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = near_duplicates(df, words_per_shingle=size).collect()
    counts, groups = brute(docs, size, 80)
    assert {r.doc_id: r.n_shingles for r in got} == counts
    assert {r.doc_id: r.component_id for r in got} == groups
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(docs)


@pytest.mark.parametrize(("seed", "n_words"), [(1, 9), (2, 60), (3, 900)])
def test_groups_equal_brute_force(spark, seed, n_words):
    same(spark, families(seed, n_words))


def test_small_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 4)
    same(spark, families(4, 120))


def test_many_classes_near_the_threshold_equal_brute_force(spark):
    """Copies that differ from each other by about the allowed difference: most pairs that the sketches allow are refused."""
    rng = random.Random(9)
    base = [f"t{i}" for i in range(200)]
    docs = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(200), 4 + i % 5):
            words[at] = f"e{rng.randint(0, 99999)}"
        docs.append((i, " ".join(words)))
    same(spark, docs)


def test_links_never_outnumber_the_rows(spark):
    docs = families(6, 80)
    made = []
    before = neardup.staged

    def watch(df, name):
        out = before(df, name)
        if name == "links":
            made.append(out.count())
        return out

    neardup.staged = watch
    try:
        same(spark, docs)
    finally:
        neardup.staged = before
    assert len(made) == 1 and made[0] <= 32 * len(docs)


def test_rows_that_share_an_id_are_one_document(spark):
    text = {x: " ".join(f"{x}{i}" for i in range(30)) for x in "XYZ"}
    rows = [(3, "X"), (5, "X"), (5, "Y"), (9, "Y"), (7, "Z"), (11, "Z"), (7, "Y"), (20, "Z")]
    got = near_duplicates(spark.createDataFrame([(i, text[x]) for i, x in rows], "doc_id long, text string")).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {3}
    apart = near_duplicates(spark.createDataFrame([(3, text["X"]), (3, text["Y"]), (4, text["Z"])], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in apart) == [(3, 3, True), (3, 3, True), (4, 4, True)]


def test_the_sample_equals_brute_force(spark, sample_docs):
    same(spark, [(r.doc_id, r.text) for r in sample_docs.collect()])


def test_whole_sketches_never_exceed_the_true_difference():
    rng = np.random.default_rng(5)
    for _ in range(50):
        pool = rng.integers(0, 2 ** 63, 600, dtype=np.int64).astype(np.uint64)
        a, b = np.unique(pool[:rng.integers(1, 500)]), np.unique(pool[rng.integers(0, 100):400])
        xor = neardup.odd_sketch(a, 0) ^ neardup.odd_sketch(b, 0)
        assert np.bitwise_count(xor).sum() <= len(np.setxor1d(a, b))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}


def test_odd_rows(odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    group = {r.doc_id: r.component_id for r in rows}
    assert group[8] == 7 and group[6] == 6 and group[1] == 1
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    assert near_duplicates(no_docs).count() == 0
