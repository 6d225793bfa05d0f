import random

import pytest
from pyspark.sql import functions as F

from gridlens.llm import linededup as L

WHITE = " \t\n\x0b\x0c\r"


def brute_force(rows):
    """(kept text, lines, dropped lines) of (doc_id, text) rows, in order."""
    keyed = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))
    held = {}
    for doc_id, text in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                if len(keyed(line)) >= 10:
                    held.setdefault(keyed(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if doc_id is None or len(held.get(keyed(x), ())) < 2 or doc_id == min(held[keyed(x)])]
        out.append(("\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def check(docs, **kw):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = L.drop_repeated_lines(docs, **kw).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "", *x[2:])
    want = sorted(((*r, *b) for r, b in zip(rows, brute_force(rows), strict=True)), key=key)
    assert sorted(((g.row.doc_id, g.row.text, g.kept, g.n_lines, g.n_dropped) for g in got), key=key) == want
    return got


def lines_table(spark, n, seed=3):
    rng = random.Random(seed)
    pool = ["short", " \tTrimmed line, Here \x0b", "trimmed line, here", "ÄÖÜ nicht klein", "äöü nicht klein", "x" * 9, "é" * 10, "É" * 10, "",
            *(f"a line of its own {i}" for i in range(3 * n))]
    rows = [(rng.choice([None, *range(n)]), "\n".join(rng.choice(pool[:9] if rng.random() < 0.4 else pool) for _ in range(rng.randint(1, 9))))
            for _ in range(n)]
    return spark.createDataFrame([*rows, (1, None), (2, "")], "doc_id long, text string")


@pytest.mark.parametrize("heavy", [L.HEAVY_PART, 1.0])
def test_lines_equal_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(L, "HEAVY_PART", heavy)
    got = check(lines_table(spark, 120))
    assert sum(g.n_dropped for g in got) > 50


def test_hash_ranges_and_flushes_lose_nothing(spark):
    """A corpus whose filters do not fit at once is worked through in ranges; filters too small only cost shuffles."""
    sizes = L.Sizes(filter_bytes=1 << 8, segment_bits=1 << 10, flush_keys=16)
    assert sizes.ranges(300) == 3 and sizes.segments(100) == 2
    check(lines_table(spark, 60), sizes=sizes)


def test_few_lines_are_suspected_by_chance(spark):
    hashes = spark.range(400_000).select(F.xxhash64("id").alias("h"))
    twice = L._Filter(hashes.unionByName(hashes.limit(1000)), 0, L._SPAN, 400_000, "twice", L.Sizes())
    suspected = hashes.where(twice.holds()("h")).count()
    assert 1000 <= suspected < 1000 + 0.01 * 400_000


def test_odd_and_empty_tables(odd_docs, no_docs):
    got = check(odd_docs)
    assert got[0].row.asDict().keys() == set(odd_docs.columns)
    assert L.drop_repeated_lines(no_docs).count() == 0
