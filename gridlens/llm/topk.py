"""Exact top-k inner products by a three-phase uniform threshold.

The components of a vector are dealt into blocks, and each block is a list of local
scores whose sum is the whole score.  Phase 1 gathers, over one tile of the candidates,
every block's k best of a query and scores these in full; the k-th best of any candidates
is a safe cutoff, whichever they are.  Phase 2 hands the cutoff to all tiles: a candidate
that can reach it must have a local score of at least cutoff / blocks somewhere, and only
such entries are taken.  Phase 3 adds up the remaining local scores of just these, and
those at the cutoff or above are ranked.  Scores are whole numbers, so the result is exact;
the tile of phase 1 decides only how many entries the later phases look at.

Queries and candidates meet in tiles of bounded size; the query set is the stated
one and no pair is ever written out but a tile's own best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.llm.common import staged

SCALE, BLOCKS = 1024, 4
#: Sizes of a tile, and how many of its queries are scored at once (blocks x 512 x 8,192 local scores of 8 bytes: 134 MB).
TILE_QUERIES, TILE_ROWS, QUERIES_AT_ONCE = 8192, 8192, 512


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null for vectors that are null or hold a null or non-finite component."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    sound = ~F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & sound, F.transform(wide, lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


def _matrix(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows by number of components: their indexes and their matrix."""
    flat = column.combine_chunks()
    sizes = np.diff(flat.offsets.to_numpy())
    values = flat.values.to_numpy()
    starts = flat.offsets.to_numpy()[:-1]
    return {int(d): (at := np.flatnonzero(sizes == d), values[starts[at][:, None] + np.arange(d)]) for d in np.unique(sizes)}


def _exact_kind(a: np.ndarray, b: np.ndarray) -> type:
    """The cheapest number type in which no inner product of these rows is rounded or overflows."""
    largest = max(1, int(np.abs(a.astype(object)).max(initial=0))) * max(1, int(np.abs(b.astype(object)).max(initial=0))) * a.shape[1]
    return np.float64 if largest < 1 << 53 else np.int64 if largest < 1 << 63 else object


def _local_scores(q: np.ndarray, c: np.ndarray, blocks: int) -> list[np.ndarray]:
    kind = _exact_kind(q, c)
    q, c = q.astype(kind), c.astype(kind)
    cuts = np.linspace(0, q.shape[1], min(blocks, max(1, q.shape[1])) + 1).astype(int)
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _listed(mine: list[np.ndarray], others: np.ndarray, k: int) -> np.ndarray:
    """Phase 1: the candidates among the k best of a block (any of equal ones: each candidate gives a safe cutoff)."""
    at = np.flatnonzero(others)
    if len(at) <= k:
        return at
    return np.unique(np.concatenate([at[np.argpartition(block[at], len(at) - k)[-k:]] for block in mine]))


def _sufficient(mine: list[np.ndarray], others: np.ndarray, cutoff: int | None) -> np.ndarray:
    """Phase 2: the candidates with a block at its share of the cutoff; all of them without one."""
    if cutoff is None:
        return np.flatnonzero(others)
    share = -(-cutoff // len(mine))
    enough = mine[0] >= share
    for block in mine[1:]:
        enough |= block >= share
    return np.flatnonzero(enough & others)


def _tile(k: int, blocks: int, phase: int):
    def run(key, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if queries.num_rows and rows.num_rows:
            q_ids, v_ids = queries.column("query_id").to_numpy(), rows.column("vec_id").to_numpy()
            cutoff = queries.column("cutoff").to_pylist()
            rest = _matrix(rows.column("v"))
            for size, (q_at, q) in _matrix(queries.column("v")).items():
                if size not in rest:
                    continue
                v_at, v = rest[size]
                ids = v_ids[v_at]
                for start in range(0, len(q_at), QUERIES_AT_ONCE):
                    local = _local_scores(q[start:start + QUERIES_AT_ONCE], v, blocks)
                    for i, at in enumerate(q_at[start:start + QUERIES_AT_ONCE]):
                        mine, others, least = [block[i] for block in local], ids != q_ids[at], cutoff[at]
                        take = _listed(mine, others, k) if phase == 1 else _sufficient(mine, others, least)
                        # phase 3: what the taken entries have in the other blocks
                        total = sum(block[take] for block in mine)
                        if least is not None:
                            take, total = take[total >= least], total[total >= least]
                        best = _best(ids[take], total, k)
                        out_q += [int(q_ids[at])] * len(best)
                        out_v += ids[take][best].tolist()
                        out_s += [int(x) for x in total[best]]
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()),
                         "score": pa.array(out_s, pa.int64())})
    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, *, blocks: int = BLOCKS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products over ``vectors``.

    Both tables hold vec_id and v (long components).  A query's own vec_id is no
    candidate; ties go to the smaller vec_id; a query with fewer than k candidates gets
    them all.  Rows with a null vec_id or a null v take no part; vectors meet only those
    with as many components.  Repeated candidate rows count one by one, repeated query
    rows once.  A score beyond 64 bits raises an error.
    """
    sound = "vec_id is not null and v is not null"
    vectors, queries = vectors.where(sound).select("vec_id", "v"), queries.where(sound).select("vec_id", "v").distinct()
    n_rows, n_queries = vectors.count(), queries.count()
    tall, wide = max(1, -(-n_queries // TILE_QUERIES)), max(1, -(-n_rows // TILE_ROWS))
    rows = staged(vectors.withColumn("column", F.expr(f"cast(pmod(xxhash64(monotonically_increasing_id()), {wide}) as int)")), "vectors")
    asked = queries.select(F.col("vec_id").alias("query_id"), "v", F.expr(f"cast(pmod(xxhash64(vec_id, v), {tall}) as int)").alias("line"))

    def meet(with_cutoff: DataFrame, phase: int) -> DataFrame:
        columns = 1 if phase == 1 else wide
        dealt = with_cutoff.withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
        copied = rows.where(F.col("column") < columns).withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(tall - 1))))
        return dealt.groupBy("line", "column").cogroup(copied.groupBy("line", "column")).applyInArrow(
            _tile(k, blocks, phase), "query_id long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = meet(asked.withColumn("cutoff", F.lit(None).cast("long")), 1)
    cutoff = ranked(first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))).where(
        F.col("rank") == k).select("query_id", F.col("score").alias("cutoff"))
    cutoff = staged(cutoff, "cutoff")
    return ranked(meet(asked.join(cutoff, "query_id", "left").select("query_id", "v", "line", "cutoff"), 2)).select(
        "query_id", "rank", "vec_id", "score")
