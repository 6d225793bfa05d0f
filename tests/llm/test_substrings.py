import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from gridlens.llm import substrings
from gridlens.llm.deepshallow import common_prefix, sort_groups
from gridlens.llm.substrings import remove_repeats


def test_groups_are_sorted_with_their_common_prefixes():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 150))) for _ in range(200)]
    base = bytes(rng.choice(b"ab") for _ in range(150))
    strings += [base[:rng.randint(90, 150)] + bytes(rng.choice(b"ab\0") for _ in range(5)) for _ in range(150)] + [base] * 5
    group = np.array([rng.randint(0, 3) for _ in strings])
    order, lcp = sort_groups(strings, group, 64)
    want = sorted(range(len(strings)), key=lambda i: (group[i], strings[i]))
    assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want]
    for j, (a, b) in enumerate(zip(order[:-1], order[1:], strict=True), 1):
        assert lcp[j] == (common_prefix(strings[a], strings[b]) if group[a] == group[b] else -1)


def brute(texts, length):
    """(kept bytes, spans) of each text, from a count of all strings."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        covered = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                covered[i:i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(int)])))
        spans = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
        out.append((bytes(np.frombuffer(b, dtype=np.uint8)[~covered[:len(b)]]) if len(b) else b"", spans))
    return out


def same(docs, length):
    got = sorted((bytes(r.kept), [(s.start, s.stop) for s in r.spans], r.n_bytes) for r in remove_repeats(docs, length=length).collect())
    texts = [r.text for r in docs.collect()]
    want = sorted((k, s, len((t or "").encode())) for (k, s), t in zip(brute(texts, length), texts, strict=True))
    assert got == want


def mosaic(spark, seed, alphabet, n, pieces=12):
    """Texts put together from shared pieces and noise, so that repeats begin and end anywhere."""
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [noise(rng.randint(20, 260)) for _ in range(pieces)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            piece = rng.choice(shared)
            a = rng.randint(0, len(piece) // 3)
            parts += [noise(rng.randint(0, 30)), piece[a:len(piece) - rng.randint(0, len(piece) // 3)]]
        texts.append("".join(parts))
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.mark.parametrize(("seed", "alphabet"), [(1, "abcdefghijklmnop"), (2, "ab"), (3, "äö☃x")])
def test_equals_brute_force(spark, seed, alphabet):
    same(mosaic(spark, seed, alphabet, 60), 50)


def test_large_groups_are_split_and_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP_ROWS", 8)
    same(mosaic(spark, 5, "abcdefgh", 150, pieces=4), 40)


def test_the_sample_equals_brute_force(sample_docs):
    same(sample_docs.select("doc_id", "text"), 200)


def test_odd_rows(spark, odd_docs, no_docs):
    same(odd_docs, 200)
    assert set(remove_repeats(odd_docs).select("row.*").columns) == set(odd_docs.columns) - {"text"}
    assert remove_repeats(no_docs).count() == 0
    runs = spark.createDataFrame([(1, "a" * 500), (2, "ab" * 300), (3, "b" * 199), (4, "b" * 199 + "c")], "doc_id long, text string")
    same(runs, 200)


def test_texts_of_surroundings_are_staged_once_and_removed(spark, sample_docs, monkeypatch):
    """Only kinds of surroundings that share a window with others have their texts written, and not beside the result."""
    seen = {}

    def recorded(df, name):
        out = plain(df, name)
        seen.setdefault(name, (out.columns, out.count()))
        return out

    plain = substrings.staged
    monkeypatch.setattr(substrings, "staged", recorded)
    before = set(substrings.staged_folders())
    noise = random.Random(4)
    copies = ["".join(noise.choice("abcdefgh") for _ in range(2000))] * 5
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(copies)], "doc_id long, text string")
    assert all(not r.kept for r in remove_repeats(docs).collect())
    assert seen["around"][1] > 0 and not {"left", "right"} & set(seen["around"][0])
    assert seen["groups"][1] == 0  # copies alone need no text
    names = [p.name for f in set(substrings.staged_folders()) - before for p in Path(f.removeprefix("file:")).iterdir()]
    assert sorted(names) == ["around", "found", "reach", "scan"]
    same(sample_docs.select("doc_id", "text"), 200)
