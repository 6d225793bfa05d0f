"""Near-duplicate groups: MinHash bands propose, odd sketches sift, full shingle sets confirm.

A document's set holds the hashes of its distinct shingles.  From it come

* a one-permutation MinHash signature (128 bins, empty bins filled from a fixed
  random order of the others), cut into 32 bands of 4: two sets with Jaccard
  similarity 0.8 share a band with probability 1 - 5e-8;
* two odd sketches.  The MinHash sample (the hashes that end in j zero bits; j grows
  with the set so that about 512 stay, and is 0 for small sets) is folded into
  1,024 parity bits.  The XOR of two sketches has at most as many ones as the
  samples differ in, so for whole sets (j = 0) a count above the bound proves
  dissimilarity; for thinned ones the estimate gets six standard deviations.

Texts with equal sets are first collapsed to one class.  Each class is confirmed against the
nearest of its buckets' centres, which already joins most of a group.  Buckets that then
hold classes of more than one component are looked at twice.  First all their
pairs are sifted by sketch, and the classes that have a pair left in another component are
listed, each pair in the first bucket it shares.  Then the full sets of these
classes alone go to the same buckets, where pairs are confirmed, nearest first, unless links already
found there join them.  What comes out is the links of a spanning forest, never the pairs, and every pair
that the sketches allow is either confirmed, refused or known to be joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm import kernels as K
from gridlens.llm.common import staged
from gridlens.llm.components import connected_components

BINS, ROWS = 128, 4
SKETCH_BITS, SAMPLE = 1024, 512
BLOCK_ROWS, TASK_ROWS, PAIRS_AT_ONCE = 2048, 8192, 1 << 17

_MULTIPLIERS = [np.uint64(0x9FB21C651E98DF25 + 2 * i * 0xD1342543DE82EF95 & (1 << 64) - 1 | 1) for i in range(64)]
_REFILL = np.argsort(np.random.default_rng(20).random((BINS, BINS)), axis=1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a block.

    A row with fewer words than ``size`` has its whole sequence as one shingle; a row
    without words has an empty set.
    """
    _, _, hashes, first = K.words(data, offsets)
    joined = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for i in range(size):
        joined += hashes[i:len(joined) + i] * _MULTIPLIERS[i]
    joined = K.mix(joined)
    out = []
    for row in range(len(offsets) - 1):
        a, b = first[row], first[row + 1]
        if b - a >= size:
            out.append(np.unique(joined[a:b - size + 1]))
        elif b > a:
            whole = np.array([np.uint64(b - a)])
            for i in range(b - a):
                whole += hashes[a + i:a + i + 1] * _MULTIPLIERS[i]
            out.append(K.mix(whole))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def band_hashes(shingles: np.ndarray) -> np.ndarray:
    """The band hashes of a non-empty sorted set (its bin minima lie at the bin starts)."""
    edges = np.arange(BINS + 1, dtype=np.uint64) << np.uint64(57)
    at = np.searchsorted(shingles, edges[:BINS])
    filled = at < np.append(np.searchsorted(shingles, edges[1:BINS]), len(shingles))
    if not filled.all():
        donor = _REFILL[np.arange(BINS), np.argmax(filled[_REFILL], axis=1)]
        at = np.where(filled, at, at[donor])
    mins = shingles[at].reshape(-1, ROWS)
    folded = np.arange(len(mins), dtype=np.uint64) * _MULTIPLIERS[ROWS]
    for i in range(ROWS):
        folded = folded + mins[:, i] * _MULTIPLIERS[i]
    return K.mix(folded)


def level_of(size):
    """How many halvings bring sets of these sizes down to the sample size."""
    return np.frexp((np.maximum(size, 1) - 1) // SAMPLE)[1]


def odd_sketch(shingles: np.ndarray, level: int) -> np.ndarray:
    """Parity bits of the sample of a set, packed."""
    sample = shingles[(shingles & np.uint64((1 << level) - 1)) == 0] if level else shingles
    bits = np.bincount(((sample >> np.uint64(20)) & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8))


def may_link(n_a, n_b, level, differing, percent: int) -> np.ndarray:
    """False only where the sketches rule out a similarity of ``percent``/100 (arrays).

    Similarity J means the sets differ in at most (1-J)/(1+J) of their summed sizes.
    """
    allowed = (n_a + n_b) * (100 - percent) / (100 + percent) / 2.0 ** level
    sampled = -SKETCH_BITS / 2 * np.log(np.maximum(1 - 2 * differing / SKETCH_BITS, 1e-9))
    loose = sampled <= allowed + 6 * np.sqrt(allowed * 1.5 + 4)
    return np.where(level == 0, differing <= allowed + 1e-9, loose) & (
        100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


_DIGEST = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, low binary, high binary"


def _digests(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, ids = K.utf8_column(batch.column("text")), batch.column("doc_id")
            for start, stop, data, offsets in K.blocks(column):
                rows = []
                for s in shingle_sets(data, offsets, size):
                    if not len(s):
                        rows.append((0, None, None, None, None, None))
                        continue
                    level = int(level_of(len(s)))
                    rows.append((len(s), int(K.signed(np.bitwise_xor.reduce(s, keepdims=True))[0]),
                                 int(K.signed(np.sum(K.mix(s), keepdims=True))[0]),
                                 K.signed(band_hashes(s)), odd_sketch(s, level).tobytes(),
                                 odd_sketch(s, level + 1).tobytes()))
                n, f1, f2, bands, low, high = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                     pa.array(f2, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(low, pa.binary()), pa.array(high, pa.binary())],
                    names=["doc_id", "n_shingles", "f1", "f2", "bands", "low", "high"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for start, stop, data, offsets in K.blocks(K.utf8_column(batch.column("text"))):
                packed = [s.tobytes() for s in shingle_sets(data, offsets, size)]
                yield pa.RecordBatch.from_arrays([ids.slice(start, stop - start), pa.array(packed, pa.binary())],
                                                 names=["id", "shingles"])
    return run


def _sketch_pairs(percent: int):
    """Keep the pairs that the sketches allow; ``differing`` is scaled to whole sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {name: batch.column(name) for name in batch.schema.names}
            n_a, n_b = col["n_a"].to_numpy(), col["n_b"].to_numpy()
            sketch = {x: np.frombuffer(b"".join(col[x].to_pylist()), dtype=np.uint64).reshape(len(n_a), -1)
                      for x in ("low_a", "low_b", "high_a", "high_b")}
            keep, ratio = _compare(n_a, n_b, *(sketch[x] for x in ("low_a", "high_a", "low_b", "high_b")), percent)
            yield pa.RecordBatch.from_arrays(
                [col["a"].filter(pa.array(keep)), col["b"].filter(pa.array(keep)), pa.array(ratio[keep])],
                names=["a", "b", "ratio"])
    return run


def _compare(n_a, n_b, low_a, high_a, low_b, high_b, percent: int):
    """(may link, estimated difference as a share of the sizes) of paired or broadcast rows."""
    j_a, j_b = level_of(n_a), level_of(n_b)
    level = np.maximum(j_a, j_b)
    mine = np.where((j_a == level)[..., None], low_a, high_a)
    yours = np.where((j_b == level)[..., None], low_b, high_b)
    differing = np.bitwise_count(mine ^ yours).sum(axis=-1).astype(np.float64)
    near = may_link(n_a, n_b, level, differing, percent) & (np.abs(j_a - j_b) <= 1)
    return near, differing * 2.0 ** level / np.maximum(n_a + n_b, 1)


class _Cells:
    """The cells (pairs of blocks of a bucket) of an Arrow table, with its rows sorted by cell."""

    def __init__(self, table: pa.Table, percent: int):
        self.percent = percent
        rows = {name: table.column(name).to_numpy() for name in ("id", "label", "n_shingles", "part", "band", "part_a", "part_b")}
        self.order = np.lexsort((rows["part"], rows["part_b"], rows["part_a"], rows["band"]))
        self.rows = {name: x[self.order] for name, x in rows.items()}
        wide = {x: np.frombuffer(b"".join(table.column(x).to_pylist()), dtype=np.uint64) for x in ("low", "high")}
        wide["bands"] = table.column("bands").combine_chunks().flatten().to_numpy()
        self.low, self.high, self.bands = (wide[x].reshape(len(self.order), -1)[self.order] for x in ("low", "high", "bands"))
        new = np.zeros(len(self.order), dtype=bool)
        for name in ("band", "part_a", "part_b"):
            new[1:] |= self.rows[name][1:] != self.rows[name][:-1]
        self.edges = [0, *np.flatnonzero(new).tolist(), len(self.order)] if len(new) else [0]

    def pairs(self, labels: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, row, estimated difference) of pairs that may link classes of different labels, a stretch of a cell at
        a time; each pair only in the first bucket that its classes share.  ``labels`` may change meanwhile."""
        n = self.rows["n_shingles"]
        for begin, end in zip(self.edges[:-1], self.edges[1:], strict=True):
            inner = self.rows["part_a"][begin] == self.rows["part_b"][begin]
            split = begin + int(np.searchsorted(self.rows["part"][begin:end], self.rows["part_a"][begin], side="right"))
            right = slice(begin, split) if inner else slice(split, end)
            step = max(1, PAIRS_AT_ONCE // max(1, right.stop - right.start))
            for at in range(begin, split, step):
                left = slice(at, min(at + step, split))
                apart = labels[left, None] != labels[None, right]
                if not apart.any():
                    continue
                near, ratio = _compare(n[left, None], n[None, right], self.low[left, None], self.high[left, None],
                                       self.low[None, right], self.high[None, right], self.percent)
                i, j = np.nonzero(near & apart)
                ratio = ratio[i, j]
                i, j = i + left.start, j + right.start
                keep = i < j if inner else np.ones(len(i), dtype=bool)
                same = self.bands[i] == self.bands[j]
                keep &= self.bands[i, same.argmax(axis=1)] == self.rows["band"][begin]
                if keep.any():
                    yield i[keep], j[keep], ratio[keep]


_OPEN = "band long, part_a int, part_b int, part int, id long, label long"


def _open_rows(percent: int):
    """The rows of a cell that may link to a row of another component in it."""
    def run(table: pa.Table) -> pa.Table:
        cells = _Cells(table, percent)
        marked = np.zeros(len(cells.order), dtype=bool)
        for i, j, _ in cells.pairs(cells.rows["label"]):
            marked[i] = marked[j] = True
        types = {"part_a": pa.int32(), "part_b": pa.int32(), "part": pa.int32()}
        return pa.table({c: pa.array(cells.rows[c][marked], types.get(c, pa.int64())) for c in (x.split()[0] for x in _OPEN.split(", "))})
    return run


def _links(percent: int):
    """Confirmed links between components, as many as join them and no more."""
    def run(table: pa.Table) -> pa.Table:
        cells = _Cells(table, percent)
        packed = table.column("shingles").to_pylist()
        sets = [np.frombuffer(packed[i], dtype=np.uint64) for i in cells.order]
        roots, found = cells.rows["label"].copy(), {"a": [], "b": []}
        for i, j, ratio in cells.pairs(roots):
            for at in np.argsort(ratio, kind="stable").tolist():
                x, y = int(i[at]), int(j[at])
                if roots[x] == roots[y]:
                    continue
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    found["a"].append(int(min(cells.rows["id"][x], cells.rows["id"][y])))
                    found["b"].append(int(max(cells.rows["id"][x], cells.rows["id"][y])))
                    roots[roots == roots[y]] = roots[x]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in found.items()})
    return run


def _confirm(percent: int):
    """Pairs whose full sets reach the similarity, in whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("s_a"), batch.column("s_b"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("s_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "s_a", "s_b").mapInArrow(
        _confirm(percent), "a long, b long, linked boolean")


def near_duplicates(docs: DataFrame, *, words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Two documents are linked when 100 * |intersection| >= percent * |union| of their
    shingle sets; ``component_id`` is the smallest doc_id reachable over links and
    ``kept`` marks the rows that carry it.  Null or wordless texts have an empty set
    and no links, so each such row is a component.  Rows that share a doc_id are one document: what is linked
    with one of them is linked with all that have words.  A row with a null
    doc_id is counted but takes no part: its component is null and it is kept.
    Empty tables give empty results; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    digests = staged(docs.mapInArrow(_digests(words_per_shingle), _DIGEST), "digests")
    some = digests.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("id"))
    heads = some.join(classes.select("f1", "f2", "n_shingles", F.col("id").alias("doc_id")),
                      ["f1", "f2", "n_shingles", "doc_id"], "left_semi").dropDuplicates(
                          ["f1", "f2", "n_shingles", "doc_id"])

    entries = heads.select(F.col("doc_id").alias("id"), F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre < last")
    members = staged(entries.join(shared.select("band", "centre"), "band"), "members")
    active = members.select("id").distinct()
    sketches = staged(heads.withColumnRenamed("doc_id", "id").join(active, "id", "left_semi")
                      .select("id", "n_shingles", "low", "high", "bands"), "sketches")
    sets = staged(docs.withColumnRenamed("doc_id", "id").join(active, "id", "left_semi")
                  .select(F.col("id").alias("doc_id"), "text").dropDuplicates().mapInArrow(
                      _sets(words_per_shingle), "id long, shingles binary"), "sets")

    def side(name: str) -> DataFrame:
        return sketches.select(F.col("id").alias(name), F.col("n_shingles").alias(f"n_{name}"),
                               F.col("low").alias(f"low_{name}"), F.col("high").alias(f"high_{name}"))

    stars = members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    sifted = stars.join(side("a"), "a").join(side("b"), "b").mapInArrow(_sketch_pairs(percent), "a long, b long, ratio double")
    nearest = sifted.groupBy("b").agg(F.min_by("a", F.struct("ratio", "a")).alias("a"))
    checked = staged(_confirmed(nearest, sets, percent), "checked")

    links = checked.where("linked").select("a", "b").union(_same_document(some, classes))
    labels = staged(connected_components(links), "labels")
    cells = staged(_cells(members.join(labels, "id", "left").select("band", "id", F.coalesce("label", "id").alias("label"))), "cells")
    open_ = staged(_by_cell(cells, sketches).applyInArrow(_open_rows(percent), _OPEN), "open")
    more = staged(_by_cell(open_, sketches.join(sets, "id")).applyInArrow(_links(percent), "a long, b long"), "links")
    if not more.isEmpty():
        labels = staged(connected_components(links.union(more)), "labels")
    classes = classes.join(labels, "id", "left").select(
        "f1", "f2", "n_shingles", F.coalesce("label", "id").alias("class_label"))
    return digests.select("doc_id", "n_shingles", "f1", "f2").join(classes, ["f1", "f2", "n_shingles"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_label", "doc_id")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _same_document(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of the rows that share a doc_id."""
    key = ["f1", "f2", "n_shingles"]
    several = rows.groupBy("doc_id").agg(F.min(F.struct(*key)).alias("x"), F.max(F.struct(*key)).alias("y")).where("x <> y")
    held = rows.join(several.select("doc_id"), "doc_id", "left_semi").join(classes, key).select("doc_id", "id").distinct()
    return held.groupBy("doc_id").agg(F.min("id").alias("a")).join(held, "doc_id").select("a", F.col("id").alias("b"))


def _cells(placed: DataFrame) -> DataFrame:
    """The buckets that hold several components, cut into cells.

    A bucket is dealt into blocks of BLOCK_ROWS rows on average and every pair of blocks is a
    cell, so no task's share grows with a bucket."""
    mixed = placed.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("size")).where(
        "x < y").select("band", F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("parts"))
    rows = placed.join(mixed, "band").withColumn("part", F.expr("cast(pmod(xxhash64(id, 5), parts) as int)")).withColumn(
        "other", F.explode(F.expr("sequence(0, parts - 1)")))
    return rows.select("band", "id", "label", "part", F.least("part", "other").alias("part_a"),
                       F.greatest("part", "other").alias("part_b"))


def _by_cell(rows: DataFrame, held: DataFrame):
    """Rows of cells with what is ``held`` for their ids, grouped to bins of about TASK_ROWS rows that hold whole cells."""
    bins = max(1, -(-rows.count() // TASK_ROWS))
    return rows.join(held, "id").withColumn("bin", F.expr(f"pmod(xxhash64(band, part_a, part_b), {bins})")).groupBy("bin")


SQL = r"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
sets AS (SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(words) - 3), lambda i: array_to_string(words[i:i + 3], ' '))) END AS held FROM texts),
entries AS (SELECT r, doc_id, len(held) AS n, unnest(held) AS shingle FROM sets),
near AS (SELECT x.doc_id AS a, y.doc_id AS b FROM entries x JOIN entries y ON x.shingle = y.shingle AND x.r <> y.r
  GROUP BY x.r, y.r, x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
walk AS (SELECT DISTINCT doc_id AS id, doc_id AS other FROM documents
  UNION SELECT walk.id, near.b FROM walk JOIN near ON walk.other = near.a),
smallest AS (SELECT id, min(other) AS component_id FROM walk GROUP BY id)
SELECT doc_id, CAST(len(held) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN smallest ON doc_id = id
"""
