import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlens.llm import topk
from gridlens.llm.topk import exact_top_k, quantised


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in rows if c != q and len(w) == len(v))
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(found[:k])]
    return sorted(out)


def test_small_tiles_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_QUERIES", 7)
    monkeypatch.setattr(topk, "TILE_ROWS", 50)
    rng = random.Random(4)
    rows = [(i, [rng.randint(-9, 9) for _ in range(6)]) for i in range(400)] + [(400 + i, [1, 2, 3, 4, 5, 6]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = sorted(map(tuple, exact_top_k(df, df.where("vec_id % 20 = 0"), 5).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == brute(rows, [r for r in rows if r[0] % 20 == 0], 5)


def test_cutoffs_are_safe_and_leave_most_entries_out():
    rng = np.random.default_rng(11)
    v = rng.integers(-500, 500, size=(3000, 64))
    v[:40] = v[0] + rng.integers(-60, 60, size=(40, 64))
    ids, queries, looked = np.arange(3000), range(0, 40, 8), 0
    for q in queries:
        mine = [block[0] for block in topk._local_scores(v[q:q + 1], v, topk.BLOCKS)]
        whole = v @ v[q]
        assert (sum(mine) == whole).all()
        some = (ids < 800) & (ids != q)  # the tile of phase 1
        first = topk._listed(mine, some, 10)
        cutoff = int(np.sort(whole[first])[-10])
        taken = topk._sufficient(mine, ids != q, cutoff)
        best = topk._best(ids[ids != q], whole[ids != q], 10)
        assert set(ids[ids != q][best]) <= set(taken)
        looked += len(taken)
        assert len(topk._sufficient(mine, ids != q, None)) == 2999
    assert looked < 0.05 * 3000 * len(queries)


def test_unsound_vectors_take_no_part_and_few_candidates_are_all_given(spark):
    rows = [(0, [0.5, -0.0001]), (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [1.0]), (1, [1.0, 2.0]), (7, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", quantised(F.col("embedding")).alias("v"))
    got = [tuple(r) for r in exact_top_k(df, df.where("vec_id = 0"), 10).collect()]
    assert got == [(0, 1, 1, 512 * 1024 - 2048), (0, 2, 1, 512 * 1024 - 2048)]
    none = df.where("false")
    assert exact_top_k(none, none).count() == 0 and exact_top_k(df, none).count() == 0


def test_large_components_stay_exact(spark):
    big = 3_000_000_000
    rows = [(0, [big, 1]), (1, [big, 2]), (2, [big, 3])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    assert [r.score for r in exact_top_k(df, df.where("vec_id = 0")).orderBy("rank").collect()] == [big * big + 3, big * big + 2]
    over = spark.createDataFrame([(0, [2 ** 40, 1]), (1, [2 ** 40, 1])], "vec_id long, v array<long>")
    with pytest.raises(Exception):
        exact_top_k(over, over).collect()
