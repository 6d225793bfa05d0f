import random
import sys
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridlens.llm import packing
from gridlens.llm.packing import ChunkTokenizer, pack_documents, packing_patterns

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
CHUNKED = ChunkTokenizer(PATH)


PARTS = [",", "?\"", "Next", "\nNext", "×", "Ün", "word.", "…", "/", *" \n\t\r\x0b\x1c\x85\xa0\u2003ab'sé1.日", "  ", "<|endoftext|>", "'s", " the"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), max_size=4))
def test_chunks_give_the_ids_of_the_whole_text(texts):
    got = CHUNKED.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert list(np.frombuffer(ids, dtype="<u4")) == WHOLE.encode(text, add_special_tokens=False).ids


def test_patterns_place_every_length_once():
    rng = random.Random(2)
    histogram = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(40)}
    placed = dict.fromkeys(histogram, 0)
    for count, pack in packing_patterns(histogram, 100):
        assert sum(length * times for length, times in pack) <= 100
        for length, times in pack:
            placed[length] += count * times
    assert placed == histogram


def check(rows, docs, capacity):
    """Every id in one piece, and pieces gapless in their sequences."""
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = []
    for doc_id, text in docs:
        ids = np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(doc_id, at, zlib.crc32(ids[at:at + capacity].tobytes())) for at in range(0, len(ids), capacity)]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.start, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(places) == list(range(len(places)))


def test_sample_documents_are_packed_with_little_padding(sample_docs):
    rows = pack_documents(sample_docs, PATH).collect()
    check(rows, [(r.doc_id, r.text) for r in sample_docs.collect()], 2048)
    assert sum(r.length for r in rows) / (2048 * len({r.sequence_id for r in rows})) > 0.9


def test_odd_documents_and_kept_ids(odd_docs, no_docs):
    rows = pack_documents(odd_docs, PATH, capacity=64, keep_ids=True).collect()
    check(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], 64)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert pack_documents(no_docs, PATH).count() == 0


def test_what_a_worker_keeps_between_stages_is_bounded():
    """Workers outlive stages: many distinct chunks, and texts looked up in blocks, leave less than 100 MB behind."""
    tokenizer = ChunkTokenizer(PATH)
    rng = np.random.default_rng(1)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", dtype=np.uint8)
    for _ in range(18):
        words = letters[rng.integers(0, 26, (40_000, 6))]
        text = b" ".join(bytes(w) for w in words)
        tokenizer.encode([text.decode()])
    memory = tokenizer.memory
    objects = sum(sys.getsizeof(x) for c in memory.columns.values() for x in c if x is not None)
    arrays = sum(c.nbytes for c in memory.columns.values()) + memory.keys.nbytes + memory.slots.nbytes + memory.uses.nbytes
    assert objects + arrays < 100_000_000
    assert packing.LOOK_BYTES <= 1 << 19
