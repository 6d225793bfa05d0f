"""Toxicity scores from a factorization machine over hashed terms.

A text is the set of its distinct terms, hashed to 2^18 buckets; every bucket that enough rows of
the training sample hold is an input.  The less a bucket's chi-square against the labels stands out, the
smaller its value, which holds its weight down without leaving it out; terms of pairs that tell more than
either term alone have the full value.  Linear weights add up single terms, and the inner products
of the terms' factors add what only pairs of them say.  The machine is fitted by Spark ML; scoring
is one pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm import kernels as K
from gridlens.llm.common import held_out, staged

BUCKET_BITS, FACTORS = 18, 4
TRAIN_ROWS, LEAST_ROWS, FULL_SQUARE, LEAST_VALUE, ROUNDS = 20_000, 3, 20.0, 0.01, 80
#: Nats by which a pair must tell more than either of its terms: among 10^8 pairs, chance makes less than one.
PAIR_NATS, PAIRS_AT_ONCE, PLACES_AT_ONCE = 20.0, 4_000_000, 250_000


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct terms of each row of a block, in row order."""
    _, _, hashes, first = K.words(data, offsets, K.MARKS)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    both = np.unique(owner.astype(np.int64) << BUCKET_BITS | (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return both >> BUCKET_BITS, both & (1 << BUCKET_BITS) - 1


def _bucket_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop, data, offsets in K.blocks(K.utf8_column(batch.column("text"))):
            row, bucket = _terms(data, offsets)
            cuts = np.searchsorted(row, np.arange(stop - start + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(start, stop - start),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(bucket.astype(np.int32)))],
                names=["label", "buckets"])


class FactorizationMachine:
    """The fitted weights, by bucket."""

    def __init__(self, buckets: list[int], intercept: float, linear: np.ndarray, factors: np.ndarray):
        self.place = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
        self.place[buckets] = np.arange(len(buckets))
        self.intercept, self.linear, self.factors = intercept, linear, factors

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        row, bucket = _terms(data, offsets)
        at = self.place[bucket]
        row, at = row[at >= 0], at[at >= 0]
        margin = self.intercept + np.bincount(row, weights=self.linear[at], minlength=n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            margin += 0.5 * (np.bincount(row, weights=v, minlength=n) ** 2 - np.bincount(row, weights=v * v, minlength=n))
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def _nats(a: np.ndarray, n: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The bound of the chance (as -log) that ``a`` of ``n`` rows are 1 where ``share`` is usual."""
    p, q = a / n, np.clip(share, 1e-9, 1 - 1e-9)
    with np.errstate(divide="ignore", invalid="ignore"):
        return n * (np.where(p > 0, p * np.log(p / q), 0.0) + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - q)), 0.0))


def _least(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many rows of 1, or of 0, a pair with a term of this share needs to tell more than that term: of all pairs
    with as many ones, one without zeros tells most, and the other way round."""
    q = np.clip(share, 1e-9, 1 - 1e-9)
    nats = PAIR_NATS * (1 - 1e-9)
    return nats / -np.log(q), nats / -np.log1p(-q)


def _telling_pairs(shared):
    """Terms of the pairs of a class (first term modulo the classes) that tell more than either term alone.

    Pairs are counted a first term at a time, over the terms behind it in its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, cuts, places, ones, share, least_ones, least_zeros, classes = shared.value
        terms, wide = terms.astype(np.int64), len(share)
        size = np.repeat(cuts[1:], np.diff(cuts)) - np.arange(1, len(terms) + 1)
        heads = np.searchsorted(terms[places], np.arange(wide + 1))

        def counted(at: np.ndarray) -> np.ndarray:
            """In how many of the rows at these places every term is behind."""
            found, ends = np.zeros(wide, dtype=np.int64), np.cumsum(size[at])
            parts = range(0, int(ends[-1]) if len(at) else 0, PLACES_AT_ONCE)
            for part in np.split(at, np.searchsorted(ends, parts[1:])):
                n = size[part]
                behind = np.arange(n.sum()) + np.repeat(part + 1 - (np.cumsum(n) - n), n)
                found += np.bincount(terms[behind], minlength=wide)
            return found

        for c in (int(x) for batch in batches for x in batch.column("id").to_pylist()):
            told = np.zeros(wide, dtype=bool)
            for term in range(c, wide, classes):
                at = places[heads[term]:heads[term + 1]]
                one, zero = counted(at[:ones[term]]), counted(at[ones[term]:])
                other = np.flatnonzero((one + zero >= LEAST_ROWS) & (
                    (one >= np.maximum(least_ones, least_ones[term])) | (zero >= np.maximum(least_zeros, least_zeros[term]))))
                one, rows = one[other], one[other] + zero[other]
                high, low, p = np.maximum(share[other], share[term]), np.minimum(share[other], share[term]), one / rows
                tells = (p > high) & (_nats(one, rows, high) >= PAIR_NATS) | (p < low) & (_nats(one, rows, low) >= PAIR_NATS)
                told[other[tells]] = True
                told[term] |= tells.any()
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(told).astype(np.int64))], names=["term"])
    return run


def _paired(rows: DataFrame, buckets: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Which buckets are in a pair that tells more than either of its terms; rows: the bounded training sample.

    Left out are buckets that even a pair with all of their ones, or zeros, would not make tell enough."""
    spark, found = rows.sparkSession, rows.toArrow()
    out = np.zeros(len(buckets), dtype=bool)
    share = ones / (ones + zeros)
    least_ones, least_zeros = _least(share)
    able = np.flatnonzero((ones >= least_ones) | (zeros >= least_zeros))
    able = able[np.argsort((ones + zeros)[able], kind="stable")]  # the rarest first: no term has many places before many others
    place = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
    place[buckets[able]] = np.arange(len(able))
    lists, label = found.column("buckets").combine_chunks(), found.column("label").to_numpy()
    rank = np.empty(len(lists), dtype=np.int32)
    rank[np.argsort(label == 0, kind="stable")] = np.arange(len(lists))  # rows of 1 come first, so also in each term's places
    row = np.repeat(rank, lists.value_lengths().to_numpy())
    terms = place[lists.flatten().to_numpy()]
    row, terms = row[terms >= 0], terms[terms >= 0]
    order = np.lexsort((terms, row))
    row, terms = row[order], terms[order]
    cuts = np.searchsorted(row, np.arange(len(lists) + 1))
    size = np.diff(cuts)
    classes = max(1, -(-int((size * (size - 1) // 2).sum()) // PAIRS_AT_ONCE))
    # every executor keeps this on its disk, so only eight bytes a term are sent
    shared = spark.sparkContext.broadcast((terms, cuts, np.argsort(terms, kind="stable").astype(np.int32),
                                           ones[able].astype(np.int64), share[able], least_ones[able], least_zeros[able], classes))
    told = spark.range(0, classes, 1, min(classes, 48)).mapInArrow(_telling_pairs(shared), "term long").distinct().toArrow()
    out[able[told.column("term").to_numpy()]] = True
    return out


def fit_machine(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> FactorizationMachine:
    """Fit on about ``train_rows`` labelled rows that are not held out (fewer if there are fewer).

    ``labels`` has doc_id and label (0/1; nulls are passed over, the larger of several
    counts).  Without both labels in the sample, every score is the share of label 1, or
    0 if there are none.
    """
    known = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("label").cast("double").alias("label"))
    total = known.count()
    if total > train_rows:
        known = known.where(F.expr("pmod(xxhash64(doc_id, 13), 1000000)") < int(1_000_000 * train_rows / total))
    known = staged(known, "known")
    # at most about train_rows pairs of numbers, so this side is always small
    rows = staged(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id").select(
        "label", "text").mapInArrow(_bucket_lists, "label double, buckets array<int>"), "rows")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        share = ones / n if n else 0.0
        return FactorizationMachine([], np.log(max(share, 1e-9) / max(1 - share, 1e-9)), np.zeros(0), np.zeros((0, FACTORS)))
    with_, without = F.sum("label"), F.sum(1 - F.col("label"))
    counted = rows.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        with_.alias("a"), without.alias("b")).where(F.col("a") + F.col("b") >= LEAST_ROWS)
    a, b = F.col("a"), F.col("b")
    zeros = n - ones
    square = F.pow(a * (zeros - b) - b * (ones - a), 2) * n / (ones * zeros * (a + b) * F.greatest(n - a - b, F.lit(1.0)))
    table = counted.withColumn("square", square).orderBy("bucket").toArrow()
    if not table.num_rows:
        return FactorizationMachine([], np.log(ones / zeros), np.zeros(0), np.zeros((0, FACTORS)))
    buckets, squares, ones_, zeros_ = (table.column(c).to_numpy() for c in ("bucket", "square", "a", "b"))
    value = np.clip(squares / FULL_SQUARE, LEAST_VALUE, 1.0)
    value[_paired(rows, buckets, ones_, zeros_)] = 1.0
    chosen = buckets.tolist()
    place = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
    place[buckets] = np.arange(len(buckets))
    shared = docs.sparkSession.sparkContext.broadcast((place, value))

    @F.udf(VectorUDT())
    def features(held: list[int]):
        places, values = shared.value
        at = np.unique(places[np.array(held, dtype=np.int64)])
        at = at[at >= 0]
        return Vectors.sparse(len(values), at, values[at])

    data = staged(rows.select("label", features("buckets").alias("features")), "inputs")
    model = FMClassifier(factorSize=FACTORS, maxIter=ROUNDS, stepSize=0.1, regParam=0.001, initStd=0.01, seed=7,
                         solver="adamW").fit(data)
    return FactorizationMachine(chosen, model.intercept, model.linear.toArray() * value, model.factors.toArray() * value[:, None])


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in K.blocks(K.utf8_column(batch.column("text"))):
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(start, stop - start),
                                                  pa.array(shared.value.scores(data, offsets))], names=["row", "score"])
    return run


def score_toxicity(docs: DataFrame, machine: FactorizationMachine, *, carry: list[str]) -> DataFrame:
    """The ``carry`` columns of every row with ``score`` in 0 to 1; null texts score as empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    source = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), F.col("text").cast("string").alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(_score(shared), f"row {kind}, score double").select("row.*", "score")
