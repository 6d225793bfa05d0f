"""Repeated lines: two Bloom filters tell which lines may occur again, only those are shuffled.

Every distinct line key of a document becomes a pair of 64-bit hashes in a staged table.  Tasks turn
their hashes into partial filters: bits of what was seen, and bits of what was seen twice.
Merging two partial filters of a segment, a bit that both have seen is seen twice, so every
key that two documents hold has all its bits in the merged second filter; a key held once has
them there only by chance (0.3 % at 16 bits a key).  Only keys found in that filter are
shuffled, by both hashes (128 bits), to confirm that two documents hold them and to find the
smallest doc_id.  The hash space is worked through in ranges whose filters fit
``FILTER_BYTES``, so neither the driver nor a broadcast grows with the corpus.

At the end a Bloom filter of the documents that lose lines (at most ``FILTER_BYTES``)
parts the corpus: the others are answered where they are read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridlens.llm import kernels as K
from gridlens.llm.common import staged

LEAST_CHARS = 10
BITS_PER_KEY, PROBES = 16, 4
SEGMENT_BITS = 1 << 20
#: Size of the filter that is broadcast, for one range of hashes.
FILTER_BYTES = 32 << 20
FLUSH_KEYS = 1 << 20
#: Keys that hold more than this part of all suspects are fewer than its inverse, and joined by broadcast.
HEAVY_PART = 0.001

_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ranges and segments are cut by the upper half of a hash.
_SPAN = 1 << 32


def line_key(line) -> F.Column:
    """The line without white space at its ends, with A-Z lower-cased."""
    bare = F.btrim(line, F.lit(_WHITE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hashes(line) -> F.Column:
    """(h1, h2) of a line's key; null where the key is too short to count."""
    key = line_key(line)
    return F.when(F.char_length(key) >= LEAST_CHARS,
                  F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit("second")).alias("h2")))


def _lines(text) -> F.Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _bits(hashes: np.ndarray, low: int, width: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each hash within its range, and its bits there (one row per probe)."""
    unsigned = hashes.view(np.uint64) ^ np.uint64(1 << 63)  # keeps the signed order
    segment = ((unsigned >> np.uint64(32)).astype(np.int64) - low) // width
    mixed = K.mix(unsigned)
    step = (mixed >> np.uint64(32)) | np.uint64(1)
    bits = (mixed[None, :] + np.arange(PROBES, dtype=np.uint64)[:, None] * step) & np.uint64(size - 1)
    return segment, bits.astype(np.uint32)


def _partial_filters(low: int, width: int, size: int, flush: int):
    """(segment, bits seen, bits seen twice) of every ``flush`` hashes of a task."""
    def pack(hashes: np.ndarray) -> pa.RecordBatch:
        keys, counts = np.unique(hashes, return_counts=True)
        segment, bits = _bits(keys, low, width, size)
        order = np.argsort(segment, kind="stable")
        segment, bits, again = segment[order], bits[:, order], counts[order] > 1
        edges = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        rows = [(int(segment[a]), bits[:, a:b].tobytes(), bits[:, a:b][:, again[a:b]].tobytes())
                for a, b in zip(edges, [*edges[1:], len(segment)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (
            pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["segment", "once", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, flush):
                held.append(batch.column(0).slice(at, flush).to_numpy(zero_copy_only=False))
                n += len(held[-1])
                if n >= flush:
                    yield pack(np.concatenate(held))
                    held, n = [], 0
        if n:
            yield pack(np.concatenate(held))
    return run


def _merge_filters(which: str, size: int):
    def run(table: pa.Table) -> pa.Table:
        once, twice = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        for a, b in zip(table.column("once"), table.column("twice"), strict=True):
            bits = np.frombuffer(a.as_buffer(), dtype=np.uint32)
            twice[bits[once[bits]]] = True
            once[bits] = True
            twice[np.frombuffer(b.as_buffer(), dtype=np.uint32)] = True
        merged = np.packbits(twice if which == "twice" else once, bitorder="little").tobytes()
        return pa.table({"segment": table.column("segment").slice(0, 1).cast(pa.int64()), "bits": pa.array([merged], pa.binary())})
    return run


@dataclass(frozen=True)
class Sizes:
    """What bounds the memory of filters; smaller values cost more passes or more shuffled keys, not results."""

    filter_bytes: int = FILTER_BYTES
    segment_bits: int = SEGMENT_BITS
    flush_keys: int = FLUSH_KEYS

    def ranges(self, keys: int) -> int:
        return max(1, -(-keys * BITS_PER_KEY // (self.filter_bytes * 8)))

    def segments(self, keys: int) -> int:
        return max(1, min(-(-keys * BITS_PER_KEY // self.segment_bits), self.filter_bytes * 8 // self.segment_bits))


class _Filter:
    """One Bloom filter over a range of hashes, broadcast to the tasks that probe it."""

    def __init__(self, hashes: DataFrame, low: int, span: int, keys: int, which: str, sizes: Sizes):
        """For about ``keys`` hashes, of which ``low`` and ``span`` bound the upper halves."""
        segments = sizes.segments(keys)
        self.low, self.width, self.bits_each, size = low, -(-span // segments), sizes.segment_bits, sizes.segment_bits // 8
        parts = hashes.mapInArrow(_partial_filters(low, self.width, self.bits_each, sizes.flush_keys),
                                  "segment long, once binary, twice binary").groupBy("segment").applyInArrow(
            _merge_filters(which, self.bits_each), "segment long, bits binary").collect()
        bits = np.zeros(segments * size, dtype=np.uint8)
        for r in parts:
            bits[r["segment"] * size:(r["segment"] + 1) * size] = np.frombuffer(r["bits"], dtype=np.uint8)
        self.bits = hashes.sparkSession.sparkContext.broadcast(bits)

    def holds(self):
        """A column function: may the hash have been put in?"""
        low, width, size, shared = self.low, self.width, self.bits_each, self.bits

        @F.arrow_udf("boolean")
        def probe(hashes: pa.Array) -> pa.Array:
            segment, bits = _bits(hashes.to_numpy(zero_copy_only=False), low, width, size)
            stored, found = shared.value, np.ones(len(hashes), dtype=bool)
            for bit in bits:
                found &= (stored[segment * (size // 8) + (bit >> 3)] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
            return pa.array(found)
        return probe


def _dropped_keys(keys: DataFrame, n: int, sizes: Sizes) -> DataFrame:
    """(doc_id, h1, h2) of the keys that a smaller doc_id holds too, worked out range by range."""
    ranges = sizes.ranges(n)
    span = -(-_SPAN // ranges)
    out = None
    for i in range(ranges):
        low, high = i * span, min((i + 1) * span, _SPAN)
        part = keys.where(F.col("h1").between((low << 32) - (1 << 63), (high << 32) - 1 - (1 << 63))) if ranges > 1 else keys
        twice = _Filter(part.select("h1"), low, high - low, -(-n // ranges), "twice", sizes)
        suspects = staged(part.where(twice.holds()("h1")), "suspects")
        held = staged(suspects.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                                       F.count("*").alias("n")).where("first < last"), "held")
        heavy = held.where(F.col("n") > HEAVY_PART * suspects.count()).select("h1", "h2", "first")
        light = held.join(F.broadcast(heavy.select("h1", "h2")), ["h1", "h2"], "left_anti").select("h1", "h2", "first")
        found = suspects.join(F.broadcast(heavy), ["h1", "h2"]).unionByName(
            suspects.join(F.broadcast(heavy.select("h1", "h2")), ["h1", "h2"], "left_anti").join(light, ["h1", "h2"]))
        found = staged(found.where("doc_id > first").select("doc_id", "h1", "h2"), "dropped")
        twice.bits.destroy()
        out = found if out is None else out.union(found)
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text without the lines whose hashes are listed, and the numbers of lines before and taken."""
    def pairs(column) -> tuple[np.ndarray, list[int]]:
        """Both hashes of every entry side by side, and where each row's begin."""
        found = column.flatten()
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        both = np.stack([found.field(x).fill_null(0).to_numpy(zero_copy_only=False) for x in ("h1", "h2")], axis=1)
        return np.ascontiguousarray(both).view([("h1", np.int64), ("h2", np.int64)]).ravel(), [0, *np.cumsum(lengths).tolist()]

    for batch in batches:
        kept, lines, taken = [], [], []
        (mine, at), (gone, of) = pairs(batch.column("hashes")), pairs(batch.column("gone"))
        counts = pc.is_valid(batch.column("hashes").flatten()).to_numpy(zero_copy_only=False)
        for i, text in enumerate(batch.column("text").to_pylist()):
            parts, rows = (text or "").split("\n"), slice(at[i], at[i + 1])
            drop = counts[rows] & np.isin(mine[rows], gone[of[i]:of[i + 1]])
            kept.append("\n".join([line for line, d in zip(parts, drop.tolist(), strict=True) if not d]))
            lines.append(len(parts))
            taken.append(int(drop.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(taken, pa.int64())],
            names=["row", "kept", "n_lines", "n_dropped"])


def drop_repeated_lines(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """(row, kept, n_lines, n_dropped) for every row of ``docs`` (doc_id, text and any other columns).

    ``row`` is the whole input row.  A text is split at line feeds (null or empty: one empty
    line).  A line's key is the line without ASCII white space at its ends, with A-Z
    lower-cased.  Keys of at least LEAST_CHARS characters that two or more doc_ids hold lose their
    lines everywhere but in the smallest of these doc_ids, where all of them stay.  ``kept`` joins the lines
    that stay.  Rows that share a doc_id are one document.  A row with a null doc_id takes no
    part: its lines stay and count for nothing.  An empty table gives no rows.
    """
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = Observation("keys")
    keys = staged(plain.where("doc_id is not null").select("doc_id", F.explode(F.array_distinct(F.array_compact(
        F.transform(_lines(F.col("text")), _hashes)))).alias("h")).select("doc_id", "h.h1", "h.h2").observe(
            counted, F.count(F.lit(1)).alias("n")).sortWithinPartitions("h1"), "line-keys")
    dropped = _dropped_keys(keys, counted.get["n"] or 0, sizes)
    gone = staged(dropped.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("gone")), "losers")
    losers = _Filter(gone.select(F.xxhash64("doc_id").alias("h")), 0, _SPAN, gone.count(), "once", sizes)
    marked = plain.withColumn("may_lose", losers.holds()(F.xxhash64("doc_id")))
    untouched = marked.where(~F.col("may_lose")).select(
        "row", F.coalesce("text", F.lit("")).alias("kept"), F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"))
    touched = marked.where("may_lose").join(gone, "doc_id", "left").select(
        "row", "text", F.transform(_lines(F.col("text")), _hashes).alias("hashes"), "gone")
    schema = untouched.schema
    return untouched.unionByName(touched.mapInArrow(_cut, schema))


SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM rows),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
held AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT k.*, coalesce(k.doc_id > h.first, false) AS dropped FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""
