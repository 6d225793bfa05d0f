"""Alignment of two tokenizers: byte ranges on which both agree, and the id pairs linked there.

Both tokenizers' spans (character offsets of the one, spans of the other's encoded proto) give coarse
ends.  A token whose decoded bytes do not fill its span, such as a part of a multibyte
character or a byte-fallback piece, gets its end from the decoded bytes since the last token that does.  Where
tokens of both end at one byte, the text is cut into groups, and each token of the one is linked with
each of the other in its group.

Groups never reach over a chunk (see ``chunks``), so each distinct chunk is aligned once per worker.  How many
documents hold a linked pair is counted over blocks of documents: a block lists its pairs
once, however many of its documents hold them, and the counts come back to it the same way.  So the
shuffles carry pairs per block, not per document, and no task holds all pairs.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from gridlens.llm import kernels as K
from gridlens.llm.chunks import ChunkMemory, Columns, crosses, joined, objects, token_bytes
from gridlens.llm.common import staged

#: Bytes of text of a block of documents.
BLOCK_BYTES = 16 << 20
#: Groups with more links than this list each distinct pair once, with its number.
MANY_LINKS = 64
SPACE_MARK = "▁"


class Aligner:
    """Aligns texts (each with a space before it) by the tokenizer files ``a`` and ``b``."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b)
        self.bytes_a = objects(token_bytes(self.a))
        self.bytes_b = objects([self._piece_bytes(i) for i in range(self.b.get_piece_size())])
        self.length_a, self.length_b = (np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        #: Chunks can be encoded apart only if no piece reaches over the place where they are cut.
        self.parted = not any(map(crosses, pieces))
        texts = [str(i).encode() for i in range(max(len(self.bytes_a), len(pieces)))]
        self.inner, self.end_a, self.end_b = (objects([t + mark for t in texts]) for mark in (b",", b"|", b";"))
        self.memory = ChunkMemory(self.chunks)

    def _piece_bytes(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        return self.b.id_to_piece(i).replace(SPACE_MARK, " ").encode()

    def tokens(self, raw: bytes):
        """Ids and byte ends of both tokenizations of ``raw``, which starts with a space; None where they do not spell it."""
        text = raw.decode()
        first = self.a.encode(text, add_special_tokens=False)
        second = self.b.encode(text[1:], return_type="proto").pieces
        ids_a = np.array(first.ids, dtype=np.int64)
        ids_b, spans_b = np.array([x for p in second for x in (p.id, p.end)], dtype=np.int64).reshape(-1, 2).T
        if b"".join(self.bytes_a[ids_a].tolist()) != raw or b"".join(self.bytes_b[ids_b].tolist()) != raw:
            return None
        data = np.frombuffer(raw, dtype=np.uint8)
        places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(raw))  # the byte at which each character starts
        spans_a = places[np.array([end for _, end in first.offsets], dtype=np.int64)]
        return (ids_a, _ends(spans_a, self.length_a[ids_a])), (ids_b, _ends(spans_b + 1, self.length_b[ids_b]))

    def groups(self, raw: bytes):
        """(ids a, ids b, group of each token a, group of each token b, ends of the groups); None as in ``tokens``."""
        found = self.tokens(raw)
        if found is None:
            return None
        (ids_a, ends_a), (ids_b, ends_b) = found
        at = np.searchsorted(ends_b, ends_a)  # both are strictly ascending, and end together
        ends = ends_a[ends_b[at] == ends_a]
        return ids_a, ids_b, np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b), ends

    def chunks(self, chunks: list[bytes]) -> Columns:
        """What is kept of every chunk; ``bad`` marks those that a tokenizer does not spell."""
        out = [None] * len(chunks)
        for text in joined(chunks):
            self._together(text, chunks, out)
        columns = list(zip(*out, strict=True)) if out else [()] * 8
        names = ["n_a", "n_b", "n_groups", "n_links", "bad"]
        kept = {name: np.array(x, dtype=np.int64) for name, x in zip(names, columns[:5], strict=True)}
        return kept | {name: objects(list(x)) for name, x in zip(("shape", "pairs", "times"), columns[5:], strict=True)}

    def _together(self, text, chunks: list[bytes], out: list) -> None:
        """Align several chunks in one text (see ``joined``), or one by one where that text is not cut around them."""
        raw, which, starts, ends = text
        found = self.groups(raw)
        if found is None or not np.isin(np.concatenate([starts[starts > 0], ends]), found[4]).all():
            if len(which) > 1:
                for alone in joined(chunks, which):
                    self._together(alone, chunks, out)
            else:
                out[which[0]] = (0, 0, 0, 0, 1, b"", b"", b"")
            return
        ids_a, ids_b, group_a, group_b, group_ends = found
        n = len(group_ends)
        count_a, count_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
        # the written form: tokens of a, then of b, group by group; the last of each has its own mark
        last_a, last_b = np.zeros(len(ids_a), dtype=bool), np.zeros(len(ids_b), dtype=bool)
        last_a[first_a + count_a - 1], last_b[first_b + count_b - 1] = True, True
        words = np.concatenate([np.where(last_a, self.end_a[ids_a], self.inner[ids_a]), np.where(last_b, self.end_b[ids_b], self.inner[ids_b])])
        words = words[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")].tolist()
        # links of small groups one by one, of large ones by distinct pair
        links = count_a * count_b
        few = np.where(links <= MANY_LINKS, links, 0)
        group = np.repeat(np.arange(n), few)
        inner = np.arange(len(group)) - np.repeat(np.cumsum(few) - few, few)
        pairs = (ids_a[first_a[group] + inner // count_b[group]] << 16 | ids_b[first_b[group] + inner % count_b[group]]).astype(
            np.uint32).tobytes()
        low = np.where(starts > 0, np.searchsorted(group_ends, starts) + 1, 0)
        high = np.searchsorted(group_ends, ends) + 1
        sums = [np.append(0, np.cumsum(x)) for x in (count_a, count_b, links, few, count_a + count_b)]
        sizes = [(x[high] - x[low]).tolist() for x in sums[:3]]
        large = np.flatnonzero(links > MANY_LINKS)
        own = {int(np.searchsorted(high, x, side="right")) for x in large.tolist()}
        spots = [x[y].tolist() for x in sums[3:] for y in (low, high)]
        for k, (i, n_a, n_b, n_groups, n_links, first, last, begin, end) in enumerate(zip(
                which, *sizes[:2], (high - low).tolist(), sizes[2], *spots, strict=True)):
            mine, many = pairs[4 * first:4 * last], _ones(last - first)
            if k in own:
                for x in large[(large >= low[k]) & (large < high[k])].tolist():
                    (one, n_one), (two, n_two) = (np.unique(v, return_counts=True) for v in (
                        ids_a[first_a[x]:first_a[x] + count_a[x]], ids_b[first_b[x]:first_b[x] + count_b[x]]))
                    mine += (one[:, None] << 16 | two).astype(np.uint32).tobytes()
                    many += (n_one[:, None] * n_two).astype(np.uint32).tobytes()
            out[i] = (n_a, n_b, n_groups, n_links, 0, b"".join(words[begin:end]), mine, many)

    def texts(self, data: np.ndarray, offsets: np.ndarray):
        """Per text of a block: (n_a, n_b, n_groups, n_links), its written form, and its (text, pair, number) entries."""
        n = len(offsets) - 1
        filled = np.diff(offsets) > 0
        spaced = np.insert(data, offsets[:-1], 32)
        where = offsets + np.arange(n + 1)
        if self.parted:
            columns, rows, first = self.memory.look(spaced, where)
        else:
            raw = spaced.tobytes()
            columns, rows, first = self.chunks([raw[a:b] for a, b in zip(where[:-1], where[1:], strict=True)]), np.arange(n), np.arange(n + 1)
        text = np.repeat(np.arange(n), np.diff(first))
        odd = np.flatnonzero(np.bincount(text, weights=columns["bad"][rows], minlength=n) > 0)
        if len(odd):  # judge the whole text: what one chunk lacks another may hold
            raw, keep = spaced.tobytes(), ~np.isin(text, odd)
            extra = self.chunks_whole([raw[where[i]:where[i + 1]] for i in odd.tolist()])
            base = len(columns["bad"])
            columns = {name: np.concatenate([columns[name], extra[name]]) for name in extra}
            rows, text = np.concatenate([rows[keep], base + np.arange(len(odd))]), np.concatenate([text[keep], odd])
            order = np.argsort(text, kind="stable")
            rows, text = rows[order], text[order]
        keep = filled[text]
        rows, text = rows[keep], text[keep]
        sums = [np.bincount(text, weights=columns[name][rows], minlength=n).astype(np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")]
        shapes, edges = columns["shape"][rows].tolist(), np.searchsorted(text, np.arange(n + 1)).tolist()
        written = [b"".join(shapes[a:b])[:-1] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        held, many = np.unique(text.astype(np.int64) << 32 | rows, return_counts=True)
        slot = held & 0xFFFFFFFF
        parts = columns["pairs"][slot].tolist()
        sizes = np.array([len(p) // 4 for p in parts], dtype=np.int64)
        pairs = np.frombuffer(b"".join(parts), dtype=np.uint32).astype(np.int64)
        times = np.frombuffer(b"".join(columns["times"][slot].tolist()), dtype=np.uint32) * np.repeat(many, sizes)
        key = np.repeat(held >> 32, sizes) << 32 | pairs
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order].astype(np.int64)
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        return sums, written, (key[new] >> 32, key[new] & 0xFFFFFFFF, np.add.reduceat(times, new) if len(new) else times)

    def chunks_whole(self, texts: list[bytes]) -> Columns:
        """Whole texts, each by itself."""
        return self.chunks([]) | {name: np.concatenate(x) for name, x in zip(
            self.chunks([]), zip(*[self._one(t).values() for t in texts], strict=True), strict=True)}

    def _one(self, text: bytes) -> Columns:
        out = [None]
        self._together((text, [0], np.array([0]), np.array([len(text)])), [text], out)
        names = ["n_a", "n_b", "n_groups", "n_links", "bad"]
        return {n: np.array([x]) for n, x in zip(names, out[0][:5], strict=True)} | {
            n: objects([x]) for n, x in zip(("shape", "pairs", "times"), out[0][5:], strict=True)}


@lru_cache(1 << 12)
def _ones(n: int) -> bytes:
    return np.ones(n, dtype=np.uint32).tobytes()


def _ends(spans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: those of their spans, or from decoded lengths where a token does not fill its span."""
    total, rank = np.cumsum(lengths), np.arange(len(spans))
    last = np.maximum.accumulate(np.where(np.diff(spans, prepend=0) == lengths, rank, -1))
    return np.where(last == rank, spans, total + np.where(last >= 0, spans[last] - total[last], 0))


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """The process's aligner for two files: tasks of one worker share what it remembers."""
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


_DOC = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at binary, times binary"
_STAGED = f"{_DOC}, groups string, pairs array<long>, docs array<int>"


def _align(a: str, b: str, keep_groups: bool, block_bytes: int):
    """Rows of documents, and one row per block with its distinct pairs and how many documents hold each."""
    names = [x.split()[0] for x in _STAGED.split(", ")]
    types = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def emit(block: int, docs: list, entries: list):
        text, pair, times = (np.concatenate(x) for x in zip(*entries, strict=True))
        pairs, at, held = np.unique(pair, return_inverse=True, return_counts=True)
        edges = np.searchsorted(text, np.arange(len(docs) + 1)).tolist()
        at, times = at.astype(np.uint32), times.astype(np.uint32)
        rows = [(block, *doc[:-1], at[x:y].tobytes(), times[x:y].tobytes(), doc[-1], None, None)
                for doc, x, y in zip(docs, edges[:-1], edges[1:], strict=True)]
        rows.append((block, *[None] * 9, pairs, held.astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, block = aligner(a, b), TaskContext.get().partitionId() << 32
        docs, entries, size = [], [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for start, stop, data, offsets in K.blocks(K.utf8_column(batch.column("text"))):
                sums, written, (text, pair, times) = work.texts(data, offsets)
                entries.append((text + len(docs), pair, times))
                for i, (shape, *counts) in enumerate(zip(written, *(x.tolist() for x in sums), strict=True)):
                    docs.append((ids[start + i], *counts, hashlib.sha256(shape).hexdigest() if shape else "",
                                 shape.decode() if keep_groups else None))
                size += len(data)
                if size >= block_bytes:
                    yield emit(block, docs, entries)
                    docs, entries, size, block = [], [], 0, block + 1
        if docs:
            yield emit(block, docs, entries)
    return run


def _judge(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """A block's documents with the corpus-wide counts of their pairs."""
    n = pairs.num_rows
    count, best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    place = pairs.column("i").to_numpy()
    count[place], best[place] = pairs.column("n").to_numpy(), pairs.column("best").to_numpy(zero_copy_only=False)
    n_best, total = [], []
    for at, times in zip(docs.column("at"), docs.column("times"), strict=True):
        at, times = (np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in (at, times))
        times = times.astype(np.int64)
        n_best.append(int(times[best[at]].sum()))
        total.append(int((times * count[at]).sum()))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]
    return pa.table([*(docs.column(c) for c in kept), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())],
                    names=[*kept, "n_best", "count_sum"])


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, *, keep_groups: bool = False,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: n_a, n_b tokens, n_groups, n_links, groups_sha256, groups, n_best, count_sum.

    ``path_a`` is a byte-level BPE file, applied to a space and the text, ``path_b`` a piece model with byte
    fallback that adds that space itself; both take special strings as plain text.  ``groups`` is the written alignment
    (``a1,a2|b1;a3|b2,b3``), null unless ``keep_groups``; groups_sha256 its hash, '' without tokens.
    Null and empty texts, and texts that the tokens of one file do not spell byte for byte, have no
    tokens and zeros.  ``n_best`` counts the links whose pair is in as many documents as any pair of its id of a,
    ``count_sum`` adds up the documents of every link's pair.  Every row is a document, repeated and null ids included.
    Only doc_id and text are read; an empty table gives no rows.
    """
    done = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                  .mapInArrow(_align(path_a, path_b, keep_groups, block_bytes), _STAGED), "aligned")
    held = done.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("i", "x")).select(
        "block", "i", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = held.groupBy("pair").agg(F.sum("docs").alias("n"))
    # an id has at most as many pairs as the other vocabulary has ids
    same = Window.partitionBy(F.shiftright("pair", 16))
    rated = counts.withColumn("best", F.col("n") == F.max("n").over(same))
    back = held.join(rated, "pair").select(F.col("block").alias("of_block"), "i", "n", "best")
    rows = done.where("pairs is null").drop("pairs", "docs")
    return rows.groupBy("block").cogroup(back.groupBy("of_block")).applyInArrow(
        _judge, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, n_best long, count_sum long")
