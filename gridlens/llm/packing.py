"""Sequence packing: shortest-pack-first over the histogram of piece lengths.

Documents are tokenised once and cut into full-length pieces and one rest.  Only
the histogram of the rests' lengths (at most ``capacity`` rows, whatever the corpus)
reaches the driver, where lengths are placed longest first, each into the packs
with the most room that still hold it.  The outcome is a list of packing patterns with
counts; pieces find their place in it by their rank among pieces of equal length.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridlens.llm import kernels as K
from gridlens.llm.chunks import ChunkMemory, Columns, joined, objects, token_bytes
from gridlens.llm.common import shuffle_width, staged

CAPACITY, END_ID = 2048, 1
#: Bytes of text looked up at once.  Workers outlive a stage, so what they hold (about 150 bytes for each chunk
#: remembered, tables in proportion to a block) adds to the memory of every later one.
LOOK_BYTES = 1 << 19
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


class ChunkTokenizer:
    """Token ids of whole texts from a byte-level BPE file; each distinct chunk (see ``chunks``) is encoded once.

    New chunks are encoded in short texts, whose ids are parted where the chunks' decoded bytes end."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.lengths = np.array([len(b) for b in token_bytes(self.tokenizer)])
        self.memory = ChunkMemory(self._chunks)

    def _ids(self, texts: list[str]) -> list[array]:
        return [array("I", e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: list[bytes]) -> Columns:
        out: list[bytes | None] = [None] * len(chunks)
        texts = list(joined(chunks))
        for (raw, which, starts, ends), ids in zip(texts, self._ids([t[0].decode() for t in texts]), strict=True):
            total = np.append(0, np.cumsum(self.lengths[np.frombuffer(ids, dtype=np.uint32)]))
            low, high = np.searchsorted(total, starts), np.searchsorted(total, ends)
            if total[-1] == len(raw) and (total[low] == starts).all() and (total[high] == ends).all():
                coded = ids.tobytes()
                for i, a, b in zip(which, low.tolist(), high.tolist(), strict=True):
                    out[i] = coded[4 * a:4 * b]
        left = [i for i, ids in enumerate(out) if ids is None]  # not parted as expected: each by itself
        for i, ids in zip(left, self._ids([chunks[i].decode() for i in left]), strict=True):
            out[i] = ids.tobytes()
        return {"ids": objects(out)}

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text of a block."""
        columns, rows, first = self.memory.look(data, offsets)
        ids, edges = columns["ids"][rows].tolist(), first.tolist()
        return [b"".join(ids[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        data, offsets = K.buffers(K.utf8_column(pa.array(texts, pa.string())))
        return self.encode_block(data[offsets[0]:offsets[-1]], offsets - offsets[0])


_tokenizers: dict[str, ChunkTokenizer] = {}


def _tokenizer(path: str) -> ChunkTokenizer:
    """The process's tokenizer for a file: tasks of one worker share what it remembers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


def _pieces(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = _tokenizer(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids = batch.column("doc_id")
            for at, _, data, offsets in K.blocks(K.utf8_column(batch.column("text")), LOOK_BYTES):
                rows = []
                for i, coded in enumerate(tokenizer.encode_block(data, offsets), at):
                    coded += end
                    total = len(coded) // 4
                    for start in range(0, total, capacity):
                        part = coded[4 * start:4 * (start + capacity)]
                        rows.append((i, start, len(part) // 4, zlib.crc32(part), total, part if keep_ids else None))
                i, start, length, crc, total, part = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(i)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                     pa.array(part, pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    return run


def packing_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(count, [(length, how many)]) patterns for a histogram of lengths, shortest pack first.

    ``open_`` lists the unfinished packs by room left.  A length goes to the packs with
    the most room; a group of equal packs is split when fewer pieces than packs remain.
    """
    open_: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    full: list[tuple[int, list[tuple[int, int]]]] = []

    def put(count: int, pack: list[tuple[int, int]], room: int) -> None:
        if room:
            open_.setdefault(room, []).append((count, pack))
        else:
            full.append((count, pack))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_, default=0)
            if room < length:
                put(left, [(length, 1)], capacity - length)
                left = 0
                continue
            count, pack = open_[room].pop()
            if not open_[room]:
                del open_[room]
            used = min(count, left)
            if used < count:
                put(count - used, pack, room)
            last, times = pack[-1]
            put(used, [*pack[:-1], (length, times + 1)] if last == length else [*pack, (length, 1)], room - length)
            left -= used
    return full + [group for groups in open_.values() for group in groups]


def _places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Where the r-th piece of a length goes, as runs of ranks (one run per pattern and length)."""
    runs, taken, base = [], {}, 0
    for count, pack in patterns:
        offset = 0
        for length, times in pack:
            rank = taken.get(length, 0)
            runs.append((length, rank, base, offset, times))
            taken[length] = rank + count * times
            offset += length * times
        base += count
    runs.sort()
    return dict(zip(("length", "rank", "base", "offset", "times"),
                    np.array(runs, dtype=np.int64).reshape(-1, 5).T.copy(), strict=True))


def _assign(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        key = p["length"] << np.int64(44) | p["rank"]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(key, length << np.int64(44) | rank, side="right") - 1
            inner = rank - p["rank"][at]
            sequence = p["base"][at] + inner // p["times"][at]
            offset = p["offset"][at] + inner % p["times"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")),
                 pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, end_id: int = END_ID,
                   keep_ids: bool = False) -> DataFrame:
    """One row per piece of every document: its ids' place, and its sequence and offset there.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, ids (little-endian unsigned
    32-bit, null unless ``keep_ids``), sequence_id, offset.  A null or empty text is
    the end id alone.  Rows with equal or null doc_ids are packed as separate
    documents.  Only doc_id and text are read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                    .mapInArrow(_pieces(tokenizer_path, capacity, end_id, keep_ids), _PIECE)
                    .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    salts = 4 * shuffle_width(spark)
    pieces = pieces.withColumn("salt", F.expr(f"pmod(xxhash64(uid), {salts})"))
    counts = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(packing_patterns(histogram, capacity)))
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).select(
            "length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = pieces.withColumn("in_salt", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("uid"))).join(before, ["length", "salt"]).withColumn(
            "rank", F.col("before") + F.col("in_salt") - 1)
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "rank").mapInArrow(
        _assign(places), f"{_PIECE}, sequence_id long, offset long")
