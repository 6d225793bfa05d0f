"""Repeated substrings: every byte covered by a long string that starts in two places goes.

Sorting all suffixes of a corpus would move each byte many times, so only suffixes
at *anchors* are sorted.  An anchor is a position whose 64-byte window hash is the
smallest among the windows of some 200-byte string around it; equal strings choose equal
anchors, so two equal 200-byte strings meet at a common one.  Around each
anchor whose window occurs twice stand a left part (at most 136 bytes) and a right part
(at most 200); equal surroundings are counted together, and the differing ones of
a window are put in suffix order, rightwards and, mirrored, leftwards, by
deep-shallow sorting.  A 200-byte string that begins i bytes before the anchor
occurs twice if and only if another row agrees on i bytes to the left and 200 - i
to the right, that is, lies in the same run of both orders at these depths.

A window with very many different surroundings is split by halving the range of
i: each half is regrouped by the bytes common to all its strings, until groups are
small or the range is one string long.  No group is compared pair by pair or held
in one task beyond the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm import kernels as K
from gridlens.llm.common import remove_folders, staged, staged_folders
from gridlens.llm.deepshallow import sort_groups

SEED_BYTES = 64
GROUP_ROWS = 4096
TASK_ROWS = 8192
SCAN_BYTES = 1 << 18

_NONE = np.uint64((1 << 64) - 1)


def _sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """op over every run of ``width`` entries, by doubling."""
    done = 1
    while 2 * done <= width:
        a = op(a[:-done], a[done:])
        done *= 2
    return op(a[:len(a) - (width - done)], a[width - done:]) if done < width else a


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, seed: int = SEED_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a block, and hashes, of the anchors of all ``length``-byte strings in its rows."""
    n, spread = len(data), length - seed + 1
    if n < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    begin = np.arange(n - seed + 1)
    hashes = K.mix(K.window_hash(K.prefix_sums(data), begin, begin + seed))
    low = _sliding(hashes, spread, np.minimum)
    legal = np.zeros(len(low), dtype=bool)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= length:
            legal[a:b - length + 1] = True
    low[~legal] = 0
    around = np.zeros(len(low) + 2 * (spread - 1), dtype=np.uint64)
    around[spread - 1:spread - 1 + len(low)] = low
    chosen = np.flatnonzero((_sliding(around, spread, np.maximum) == hashes) & (hashes != 0))
    return chosen, hashes[chosen]


def _scan(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            column = K.utf8_column(batch.column("text"))
            for start, stop, data, offsets in K.blocks(column, SCAN_BYTES):
                at, hashes = anchors(data, offsets, length, seed)
                cuts = np.searchsorted(at, offsets)
                owner = np.repeat(offsets[:-1], np.diff(cuts))
                raw = data.tobytes()
                blobs = [pack.compress(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), x)
                         for x in (pa.array(K.signed(hashes), pa.int64()), pa.array(at - owner, pa.int32()))]
                rows = stop - start
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, rows), batch.column("uid").slice(start, rows),
                     pa.array(np.diff(offsets), pa.int64()), pa.array(blobs, pa.binary()), *lists],
                    names=["row", "uid", "n_bytes", "blob", "hashes", "spots"])
    return run


def _around(text: bytes, spots: np.ndarray, length: int, seed: int) -> tuple[list[bytes], list[bytes]]:
    """What stands left and right of each anchor."""
    return [text[max(0, p - length + seed):p] for p in spots], [text[p:p + length] for p in spots]


def _looks(length: int, seed: int):
    """A hash of each anchor's surroundings, and how long they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            marks = batch.column("marks")
            for i in range(batch.num_rows):
                own = marks[i].values
                spots = own.field("spot").to_numpy()
                left, right = _around(unpack.decompress(batch.column("blob")[i].as_py()), spots, length, seed)
                look = [xxhash.xxh3_64_intdigest(b, seed=len(a)) ^ xxhash.xxh3_64_intdigest(a, seed=7)
                        for a, b in zip(left, right, strict=True)]
                uid = pa.array(np.full(len(spots), batch.column("uid")[i].as_py()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [own.field("hash"), pa.array(np.array(look, dtype=np.uint64).view(np.int64)), uid, own.field("spot"),
                     *(pa.array([len(x) for x in side], pa.int32()) for side in (left, right))],
                    names=["hash", "look", "uid", "spot", "n_left", "n_right"])
    return run


def _texts(length: int, seed: int):
    """The surroundings themselves, for one anchor of each kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            heads = batch.column("heads")
            for i in range(batch.num_rows):
                own = heads[i].values
                left, right = _around(unpack.decompress(batch.column("blob")[i].as_py()), own.field("spot").to_numpy(), length, seed)
                low, high = (pa.array(np.full(len(left), x), pa.int64()) for x in (0, length - seed))
                yield pa.RecordBatch.from_arrays(
                    [own.field("hash"), low, high, *(own.field(x) for x in ("hash", "look", "n")),
                     pa.array(left, pa.binary()), pa.array(right, pa.binary()), own.field("size")], names=[*_NODE_COLUMNS, "size"])
    return run


def repeated_reach(left: list[bytes], right: list[bytes], group: np.ndarray, low: np.ndarray, high: np.ndarray,
                   many: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row, the smallest and largest i whose string occurs twice (-1: none).

    ``group`` are whole numbers; rows of one group share their seed window; ``low`` and
    ``high`` bound i; ``many`` marks surroundings that occur several times as they are.
    """
    n = len(left)
    r_order, r_lcp = sort_groups(right, group, 96)
    l_order, l_lcp = sort_groups([x[::-1] for x in left], group, 64)
    reach_l = np.minimum(np.array([len(x) for x in left]), high)
    reach_r = np.maximum(length - np.array([len(x) for x in right]), low)

    def runs(order, lcp, depth):
        out = np.empty(n, dtype=np.int64)
        out[order] = np.cumsum(lcp < depth)
        return out

    def search(steps):
        found = np.full(n, -1, dtype=np.int64)
        for i in steps:
            open_ = (found < 0) & (reach_r <= i) & (i <= reach_l)
            if not open_.any():
                continue
            key = runs(r_order, r_lcp, length - i) * (n + 1) + runs(l_order, l_lcp, i)
            ordered = np.sort(key)
            twice = ordered[1:][ordered[1:] == ordered[:-1]]
            hit = many.copy()
            if len(twice):
                at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
                hit |= twice[at] == key
            found[open_ & hit] = i
        return found

    span = range(int(low.min()), int(high.max()) + 1) if n else range(0)
    return search(span), search(reversed(span))


def _resolve(length: int):
    def run(table: pa.Table) -> pa.Table:
        key = table.column("key").to_numpy()
        group = np.unique(key, return_inverse=True)[1]
        first, last = repeated_reach(table.column("left").to_pylist(), table.column("right").to_pylist(), group,
                                     table.column("low").to_numpy(), table.column("high").to_numpy(),
                                     table.column("n").to_numpy() > 1, length)
        found = pa.array(first >= 0)
        return pa.table({"hash": table.column("hash").filter(found), "look": table.column("look").filter(found),
                         "start": pa.array(-last[first >= 0], pa.int64()),
                         "stop": pa.array(length - first[first >= 0], pa.int64())})
    return run


def _halves(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in ("row", "key", "span", "low", "high", "left", "right")}
            for i, (key, low, high, left, right) in enumerate(zip(
                    *(batch.column(x).to_pylist() for x in ("key", "low", "high", "left", "right")), strict=True)):
                middle = (low + high) // 2
                for a, b in {(low, middle), (min(middle + 1, high), high)}:
                    if len(left) < a or len(right) < length - b:
                        continue
                    seed = (key & 0xFFFFFFFF) * 1000003 + a * 1009 + b
                    near, far = left[max(0, len(left) - b):], right[:length - a]
                    for name, value in (
                            ("row", i), ("low", a), ("high", b), ("left", near), ("right", far),
                            ("key", xxhash.xxh3_64_intdigest(left[len(left) - a:] + right[:length - b], seed=seed)),
                            ("span", xxhash.xxh3_64_intdigest(near + far, seed=seed * 311 + len(near)))):
                        out[name].append(value)
            same = batch.take(pa.array(out["row"], pa.int64()))
            long = {x: pa.array(np.array(out[x], dtype=np.uint64).view(np.int64), pa.int64()) for x in ("key", "span")}
            yield pa.RecordBatch.from_arrays(
                [long["key"], pa.array(out["low"], pa.int64()), pa.array(out["high"], pa.int64()),
                 *(same.column(x) for x in ("hash", "look", "n")), pa.array(out["left"], pa.binary()),
                 pa.array(out["right"], pa.binary()), long["span"]],
                names=["key", "low", "high", "hash", "look", "n", "left", "right", "span"])
    return run


_NODE = "key long, low long, high long, hash long, look long, n long, left binary, right binary"
_NODE_COLUMNS = ["key", "low", "high", "hash", "look", "n", "left", "right"]


def _whole(rows: DataFrame, length: int) -> DataFrame:
    """The reach of rows (with the lengths of both sides) whose every string in the range repeats."""
    return rows.select("hash", "look", (-F.least("n_left", "high")).cast("long").alias("start"),
                       F.least("n_right", length - F.col("low")).cast("long").alias("stop")).where(
                           F.col("stop") - F.col("start") >= length)


def _sided(nodes: DataFrame) -> DataFrame:
    return nodes.select("hash", "look", "low", "high", F.octet_length("left").alias("n_left"), F.octet_length("right").alias("n_right"))


def _reaches(heads: DataFrame, live: DataFrame, length: int, seed: int) -> DataFrame:
    """(hash, look, start, stop): the stretch around an anchor that repeats, for all surroundings.

    All strings of a row contain its anchor, so the repeated ones make one stretch.  ``heads`` lists all
    surroundings, ``live`` holds the texts of those that share their window with others.
    """
    found = [_whole(heads.where("n > 1").select("*", F.lit(0).alias("low"), F.lit(length - seed).alias("high")), length)]
    while True:
        small, large = f"size > 1 and size <= {GROUP_ROWS}", f"size > {GROUP_ROWS}"
        n_small, n_large = live.agg(F.count_if(F.expr(small)), F.count_if(F.expr(large))).first()
        if n_small:
            tasks = max(1, -(-n_small // TASK_ROWS))
            found.append(live.where(small).withColumn("bin", F.expr(f"pmod(xxhash64(key, 3), {tasks})")).groupBy(
                "bin").applyInArrow(_resolve(length), "hash long, look long, start long, stop long"))
        if not n_large:
            break
        halves = staged(live.where(large).select(*_NODE_COLUMNS).mapInArrow(
            _halves(length), f"{_NODE}, span long"), "halves")
        spans = halves.groupBy("key", "span").agg(F.sum("n").alias("copies"), F.min(F.struct("hash", "look")).alias("head"))
        met = halves.join(spans, ["key", "span"])
        found.append(staged(_whole(_sided(met.where("copies > 1")), length), "whole"))
        nodes = met.where(F.col("head") == F.struct("hash", "look")).select(
            *(F.col("copies").alias("n") if c == "n" else c for c in _NODE_COLUMNS))
        sized = nodes.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("copies"))
        live = staged(nodes.join(sized.where("copies > 1"), "key"), "groups")
        found.append(_whole(_sided(live.where("n > 1")), length))
    reach = found[0]
    for part in found[1:]:
        reach = reach.union(part)
    return reach.groupBy("hash", "look").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def _cut():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            spans, kept = [], []
            for blob, found in zip(batch.column("blob"), batch.column("found").to_pylist(), strict=True):
                text = unpack.decompress(blob.as_buffer())
                merged: list[list[int]] = []
                for span in sorted((x["start"], x["stop"]) for x in found or ()):
                    if merged and span[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], span[1])
                    else:
                        merged.append([*span])
                edges = [0, *(x for span in merged for x in span), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"start": a, "stop": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("n_bytes"),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["row", "n_bytes", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, *, length: int = 200, text: str = "text") -> DataFrame:
    """(row, n_bytes, spans, kept) for every row: the other columns, and what is cut and left.

    Each byte covered by a ``length``-byte string that also starts elsewhere, in the
    same or another row, is cut.  ``row`` is a struct of all columns but the text,
    ``spans`` lists the maximal cut runs as byte offsets in order, ``kept`` holds the
    bytes that remain.  Null texts count as empty; texts shorter than ``length`` are kept
    whole; repeated rows repeat each other and lose all their long strings.
    """
    seed = min(SEED_BYTES, max(1, length // 3))
    others = [c for c in docs.columns if c != text]
    source = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"),
                         F.monotonically_increasing_id().alias("uid"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    scan = staged(source.mapInArrow(_scan(length, seed), f"row {kind}, uid long, n_bytes long, blob binary, "
                                    "hashes array<long>, spots array<int>"), "scan")
    spots = scan.select("uid", F.explode(F.arrays_zip("hashes", "spots")).alias("x")).select(
        "uid", F.col("x.hashes").alias("hash"), F.col("x.spots").alias("spot"))
    twice = spots.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    marks = spots.join(twice, "hash").groupBy("uid").agg(F.collect_list(F.struct("hash", "spot")).alias("marks"))
    # numbers are grouped first, so that the texts of surroundings are read again once and not shuffled with them
    around = staged(scan.select("uid", "blob").join(marks, "uid").mapInArrow(
        _looks(length, seed), "hash long, look long, uid long, spot int, n_left int, n_right int"), "around")
    kinds = around.groupBy("hash", "look").agg(
        F.count("*").alias("n"), F.min_by("spot", "uid").alias("spot"), F.min("uid").alias("uid"),
        F.min("n_left").alias("n_left"), F.min("n_right").alias("n_right"))
    sizes = kinds.groupBy("hash").agg(F.count("*").alias("size"), F.sum("n").alias("copies"))
    behind = len(staged_folders())
    heads = staged(kinds.join(sizes.where("copies > 1").drop("copies"), "hash"), "heads")
    wanted = heads.where("size > 1").groupBy("uid").agg(F.collect_list(F.struct("hash", "look", "spot", "n", "size")).alias("heads"))
    live = staged(scan.select("uid", "blob").join(wanted, "uid").mapInArrow(_texts(length, seed), f"{_NODE}, size long"), "groups")
    reach = _reaches(heads, live, length, seed)
    done = staged_folders()
    reach = staged(reach, "reach")
    remove_folders(docs.sparkSession, done[behind:])  # all read by now
    found = staged(around.select("hash", "look", "uid", "spot").join(reach, ["hash", "look"]).groupBy("uid").agg(
        F.collect_list(F.struct((F.col("spot") + F.col("start")).alias("start"),
                                (F.col("spot") + F.col("stop")).alias("stop"))).alias("found")), "found")
    return scan.select("uid", "row", "n_bytes", "blob").join(found, "uid", "left").select(
        "row", "n_bytes", "blob", "found").mapInArrow(
            _cut(), f"row {kind}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
