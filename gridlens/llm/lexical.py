"""Ranked lexical search: exact inner products over sparse ball trees.

A document's vector holds, for every term of the query set, its saturated term frequency
(a whole number); an item's vector holds the term weights times its own counts, so the score is
an inner product of the two.  One pass over the texts stages these vectors, which are much smaller, with
what N, L and df need; a second pass puts the vectors of a task into blocks and each block into
a ball tree (splits by two far points).  A ball with centre c and radius r holds no
vector whose product with q exceeds q.c + |q| r.  Balls are opened best bound first; one
whose bound, enlarged by more than the rounding error of its terms, stays below the twentieth best
score so far is left with everything under it.  Leaves are scored in whole numbers.  The
best so far of a task carry over from block to block.  Both vectors are scaled by the
root of the term weight for the bounds, which leaves products as they are and lets rare terms shape the balls.

The items come to the driver, as they are the stated query set; they are worked on in groups of at most
GROUP_TERMS terms, which bounds what is broadcast.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.llm import kernels as K
from gridlens.llm.common import staged

BEST = 20
GROUP_TERMS = 1 << 18
BLOCK_DOCS, BLOCK_ENTRIES, LEAF_DOCS = 4096, 1 << 19, 32
#: Relative enlargement of squared radii and of bounds; errors of double sums stay far below it.
SLACK = 1e-9
SALTS = 64

_RANKED = "item_id long, rank int, doc_id long, score long"


def _terms_of(texts: list[str | None]) -> list[np.ndarray]:
    """The term hashes of each text, in order, and with repeats."""
    data, offsets = K.buffers(K.utf8_column(pa.array(texts, pa.string())))
    _, _, hashes, first = K.words(data[offsets[0]:offsets[-1]], offsets - offsets[0], K.MARKS)
    return [hashes[first[i]:first[i + 1]] for i in range(len(texts))]


class _Items:
    """A group of items as rows of (term index, count); terms are indexes into the sorted hashes."""

    def __init__(self, ids: list[int | None], terms: list[np.ndarray]):
        self.ids = ids
        self.hashes = np.unique(np.concatenate(terms)) if terms else np.zeros(0, dtype=np.uint64)
        self.rows = [np.unique(np.searchsorted(self.hashes, t), return_counts=True) for t in terms]


def _groups(items: DataFrame) -> Iterator[_Items]:
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).collect()
    terms = _terms_of([r[1] for r in rows])
    ids, held, size = [], [], 0
    for r, t in zip(rows, terms, strict=True):
        if not len(t):
            continue
        if held and size + len(t) > GROUP_TERMS:
            yield _Items(ids, held)
            ids, held, size = [], [], 0
        ids.append(r[0])
        held.append(t)
        size += len(t)
    if held:
        yield _Items(ids, held)


def _vectors(vocabulary):
    """(doc_id, number of terms, query-set terms, their occurrences) of documents with a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            ids = batch.column("doc_id")
            for start, stop, data, offsets in K.blocks(K.utf8_column(batch.column("text"))):
                _, _, hashes, first = K.words(data, offsets, K.MARKS)
                n = np.diff(first)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = np.flatnonzero(known[at] == hashes)
                row = np.searchsorted(first, hit, side="right") - 1
                keys, tf = np.unique(row * len(known) + at[hit], return_counts=True)
                edges = np.searchsorted(keys // len(known), np.arange(len(n) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x.astype(np.int32))) for x in (keys % len(known), tf)]
                out = pa.RecordBatch.from_arrays([ids.slice(start, stop - start), pa.array(n.astype(np.int64)), *lists],
                                                 names=["doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))
    return run


def _document_counts(size: int):
    """How many documents of the task hold each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(df[term])], names=["term", "df"])
    return run


def frequencies(tf: np.ndarray, n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """Saturated term frequencies, as whole numbers."""
    if len(n) and 25 * int(n.max()) * total_docs >= 1 << 63:
        share = np.array([25 * int(x) * total_docs // total_terms for x in n], dtype=np.int64)
    else:
        share = 25 * n * total_docs // total_terms
    return 1_000_000_000 * tf // (1000 * tf + 12 * (100 - 25 + share))


class BallTree:
    """A ball tree over the rows of a sparse matrix (no row empty), for products with sparse queries."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, roots: np.ndarray, leaf_docs: int = LEAF_DOCS):
        """``values`` are whole numbers; the bounds use them times ``roots`` of their terms."""
        self.names, terms = np.unique(terms, return_inverse=True)
        scaled = values * roots[self.names[terms]]
        self.scaled_roots, self.nodes, entries, order = roots[self.names], [], [], []
        n = len(starts) - 1
        lengths = np.diff(starts)
        squares = np.add.reduceat(scaled * scaled, starts[:-1]) if n else np.zeros(0)
        todo = [(np.arange(n), -1, 0)] if n else []
        while todo:  # depth first, so that the rows of a leaf end up side by side
            rows, parent, side = todo.pop()
            at = _runs(starts[rows], lengths[rows])
            first = np.cumsum(lengths[rows]) - lengths[rows]
            centre = np.bincount(terms[at], weights=scaled[at], minlength=len(self.names)) / len(rows)

            def distances(point, at=at, first=first, rows=rows):
                return squares[rows] - 2 * np.add.reduceat(scaled[at] * point[terms[at]], first) + point @ point

            apart = distances(centre)
            radius = math.sqrt(max(apart.max(), 0.0) + SLACK * (squares[rows].max() + centre @ centre))
            me = len(self.nodes)
            self.nodes.append([radius, -1, -1, 0, 0])
            if parent >= 0:
                self.nodes[parent][1 + side] = me
            held = np.flatnonzero(centre)
            entries.append((held, np.full(len(held), me), centre[held]))
            if len(rows) <= leaf_docs:
                self.nodes[me][3:] = [len(order), len(order) + len(rows)]
                order.extend(rows.tolist())
                continue
            a = self._row(starts, terms, scaled, rows[int(apart.argmax())])
            from_a = distances(a)
            b = self._row(starts, terms, scaled, rows[int(from_a.argmax())])
            near = from_a <= distances(b)
            if near.all() or not near.any():  # equal rows: any halves do
                near = np.arange(len(rows)) < len(rows) // 2
            todo += [(rows[~near], me, 1), (rows[near], me, 0)]
        self.order = np.array(order, dtype=np.int64)
        at = _runs(starts[self.order], lengths[self.order])
        self.starts = np.concatenate([[0], np.cumsum(lengths[self.order])]).astype(np.int64)
        self.terms, self.values = terms[at], values[at]
        term, node, value = (np.concatenate(x) for x in zip(*entries, strict=True)) if entries else (np.zeros(0, dtype=np.int64),) * 3
        by_term = np.argsort(term, kind="stable")
        self.centre_starts = np.searchsorted(term[by_term], np.arange(len(self.names) + 1))
        self.centre_nodes, self.centre_values = node[by_term], value[by_term]

    def _row(self, starts, terms, scaled, row) -> np.ndarray:
        point = np.zeros(len(self.names))
        point[terms[starts[row]:starts[row + 1]]] = scaled[starts[row]:starts[row + 1]]
        return point

    def search(self, terms: np.ndarray, weights: np.ndarray, least) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, exact products) of leaves, best bound first, while a bound reaches ``least()``.

        ``weights`` are the whole-number weights of the query's sorted ``terms``."""
        mine = np.searchsorted(self.names, terms)
        mine = np.minimum(mine, len(self.names) - 1)
        known = self.names[mine] == terms
        mine, weights = mine[known], weights[known]
        if not len(mine):
            return
        scaled = weights / np.maximum(self.scaled_roots[mine], 1e-300)  # a weight of 0 has a root of 0
        size = math.sqrt(float(scaled @ scaled))
        lengths = self.centre_starts[mine + 1] - self.centre_starts[mine]
        at = _runs(self.centre_starts[mine], lengths)
        products = np.bincount(self.centre_nodes[at], weights=self.centre_values[at] * np.repeat(scaled, lengths),
                               minlength=len(self.nodes)).tolist()
        dense = np.zeros(len(self.names), dtype=np.int64)
        dense[mine] = weights

        def bound(node: int) -> float:
            return (products[node] + size * self.nodes[node][0]) * (1 + SLACK) + 1.0

        heap = [(-bound(0), 0)]
        while heap:
            high, node = heapq.heappop(heap)
            if -high < least():
                return
            _, left, right, low, end = self.nodes[node]
            if left < 0:
                a, b = self.starts[low], self.starts[end]
                yield self.order[low:end], np.add.reduceat(self.values[a:b] * dense[self.terms[a:b]], self.starts[low:end] - a)
            else:
                for child in (left, right):
                    heapq.heappush(heap, (max(high, -bound(child)), child))


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the ranges [start, start + length), one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


class _Best:
    """The best rows of one item so far: highest score first, then smallest id, null ids last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = scores >= self.least()
        if good.any():
            s, i, z = (np.concatenate([a, b[good]]) for a, b in ((self.scores, scores), (self.ids, ids), (self.null, null)))
            top = np.lexsort((i, z, -s))[:self.k]
            self.scores, self.ids, self.null = s[top], i[top], z[top]


def _search(shared, k: int, block_docs: int, leaf_docs: int):
    """Each item's best documents of a task."""
    def blocks(batches):
        for batch in batches:
            at = 0
            ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                stop = int(np.searchsorted(ends, before + BLOCK_ENTRIES, side="right"))
                stop = min(batch.num_rows, at + block_docs, max(stop, at + 1))
                yield batch.slice(at, stop - at)
                at = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, weights, docs, terms = shared.value
        best = [_Best(k) for _ in rows]
        roots = np.sqrt(weights.astype(np.float64))
        queries = [(t, weights[t] * c) for t, c in rows]
        for block in blocks(batches):
            lists = block.column("terms")
            starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = block.column("tfs").flatten().to_numpy().astype(np.int64)
            n = np.repeat(block.column("n").to_numpy(), np.diff(starts))
            tree = BallTree(starts, term, frequencies(tf, n, docs, terms), roots, leaf_docs)
            ids = block.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            null = block.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            for (t, w), found in zip(queries, best, strict=True):
                for where, scores in tree.search(t, w, found.least):
                    found.add(scores, ids[where], null[where])
        item = np.repeat(np.arange(len(best)), [len(b.scores) for b in best])
        ids, null, scores = (np.concatenate([getattr(b, x) for b in best]) for x in ("ids", "null", "scores"))
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(ids, mask=null), pa.array(scores)],
                                         names=["item", "doc_id", "score"])
    return run


def _top(rows: DataFrame, k: int, *groups: str) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = BEST, *, block_docs: int = BLOCK_DOCS,
                  leaf_docs: int = LEAF_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, best first.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored.  Only scores
    above 0 are ranked; equal scores go by ascending doc_id, null ids last.  Every row of
    ``docs`` is a document and every row of ``items`` an item, repeated ids included.  Null and
    term-less texts hold nothing and count for nothing; empty tables give no rows.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], _RANKED)
    for group in _groups(items):
        size = len(group.hashes)
        vectors = staged(plain.mapInArrow(_vectors(spark.sparkContext.broadcast(group.hashes)),
                                          "doc_id long, n long, terms array<int>, tfs array<int>"), "vectors")
        docs_with_terms, terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(size, dtype=np.int64)
        for r in vectors.select("terms").mapInArrow(_document_counts(size), "term int, df long").groupBy("term").agg(
                F.sum("df").alias("df")).collect():
            df[r["term"]] = r["df"]
        weights = np.array([math.floor(1000 * math.log((2 * docs_with_terms + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
        shared = spark.sparkContext.broadcast((group.rows, weights, docs_with_terms, terms))
        found = vectors.where(F.size("terms") > 0).mapInArrow(_search(shared, k, block_docs, leaf_docs), "item int, doc_id long, score long")
        # in two steps, so that no task gathers the findings of all tasks
        best = _top(_top(found.withColumn("salt", F.spark_partition_id() % SALTS), k, "item", "salt"), k, "item")
        names = spark.createDataFrame(list(enumerate(group.ids)), "item int, item_id long")
        out = out.unionByName(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
total AS (SELECT count(*) AS big_n, CAST(sum(len(terms)) AS BIGINT) AS big_l FROM docs WHERE len(terms) > 0),
held AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM docs),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM tf, total GROUP BY term, big_n),
scored AS (SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + ((25 * n * big_n) // big_l))))) AS BIGINT) AS score
    FROM items JOIN tf USING (term) JOIN weight USING (term), total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
