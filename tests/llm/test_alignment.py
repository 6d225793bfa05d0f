import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridlens.llm import alignment as A
from gridlens.llm import kernels as K

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALIGNER = A.aligner(*PATHS)
PARTS = [" ", "  ", "\n", "a", "é", "日", "本", "☃", " the", "word", "▁", " ", "　", "\x00", "\x1c", "'s", "<s>", "🤦🏼", "ﬁ", "\t",
         "<|endoftext|>", ".", "1", ",", "?\"", "Next", "\nNext", "×", "Ün", "word.", "…", "/", "<b>", "​", " é", "\x7f", "\u0085", "xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx"]


def groups(text):
    """[(ids of a, ids of b)] by decoded bytes alone, over the whole text."""
    if not text:
        return []
    raw = f" {text}".encode()
    ids = ALIGNER.a.encode(f" {text}", add_special_tokens=False).ids, ALIGNER.b.encode(text)
    spelt = [[table[i] for i in x] for table, x in zip((ALIGNER.bytes_a, ALIGNER.bytes_b), ids, strict=True)]
    if any(b"".join(x) != raw for x in spelt):
        return []
    ends = [{end: i for i, end in enumerate(np.cumsum([len(t) for t in x]).tolist(), 1)} for x in spelt]
    out, at = [], [0, 0]
    for cut in sorted(ends[0].keys() & ends[1].keys()):
        stop = [e[cut] for e in ends]
        out.append(tuple(ids[side][at[side]:stop[side]] for side in (0, 1)))
        at = stop
    return out


def written(found):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)


def linked(found):
    out = Counter()
    for x, y in found:
        for a, n in Counter(x).items():
            for b, m in Counter(y).items():
                out[a, b] += n * m
    return out


def brute_force(texts):
    every = [groups(t) for t in texts]
    held = Counter(pair for g in every for pair in linked(g))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for g in every:
        links = linked(g)
        out.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(links.values()),
                    sum(n for pair, n in links.items() if held[pair] == best[pair[0]]),
                    sum(n * held[pair] for pair, n in links.items()), hashlib.sha256(written(g).encode()).hexdigest() if g else "", written(g)))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), min_size=1, max_size=5))
def test_chunked_alignment_is_that_of_the_whole_text(texts):
    data, offsets = K.buffers(K.utf8_column(pa.array(texts, pa.string())))
    sums, shapes, (text, pair, times) = ALIGNER.texts(data[:offsets[-1]], offsets)
    for i, t in enumerate(texts):
        want = groups(t)
        assert shapes[i].decode() == written(want)
        assert [int(s[i]) for s in sums] == [sum(len(a) for a, _ in want), sum(len(b) for _, b in want), len(want), sum(linked(want).values())]
        mine = text == i
        assert dict(zip(pair[mine].tolist(), times[mine].tolist())) == {a << 16 | b: n for (a, b), n in linked(want).items()}


def check(docs, **kw):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = A.align_tokenizers(docs, *PATHS, keep_groups=True, **kw).collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    want = [(d, *b) for (d, _), b in zip(rows, brute_force([t for _, t in rows]), strict=True)]
    assert sorted(((g.doc_id, *(g[n] for n in names)) for g in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("block", [A.BLOCK_BYTES, 4000])
def test_documents_equal_brute_force(spark, odd_docs, block):
    rng = random.Random(7)
    words = ["the", "naïve", "日本語", "blorthink", "a", "ciónñ", "<|endoftext|>"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(60)]
    check(odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string")), block_bytes=block)


def test_sample_documents(sample_docs, no_docs):
    check(sample_docs.limit(60))
    assert A.align_tokenizers(no_docs, *PATHS).count() == 0


def test_special_strings_are_plain_text_and_marks_are_not_spelt():
    assert len(groups("a <|endoftext|> b")[0][0]) == 1 and 50256 not in ALIGNER.a.encode(" <|endoftext|>").ids
    assert groups("a ▁ b") == []  # the model reads its own space mark as a space
    assert ALIGNER.parted
