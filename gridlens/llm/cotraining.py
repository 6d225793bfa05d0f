"""Quality classification by co-training a text view and a metadata view.

The text view is the frequency of hashed byte trigrams; the metadata view is what is
known of a document without its wording: source, language label, length and layout
counts.  Each view has a logistic model of its own.  In every round both judge all unlabelled
documents in one scan, and of those that one model is sure about, up to a fixed number for
each label becomes training rows of the other.  The two are then calibrated together on labelled
rows that neither was trained on, and one pass scores all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm import kernels as K
from gridlens.llm.common import held_out, staged

TEXT_INPUTS, NAME_INPUTS = 512, 32
#: LENT_ROWS: how many rows a view lends the other in a round, at most, for each label.
LABELLED_ROWS, LENT_ROWS, ROUNDS, SURE = 8_000, 2_000, 3, 0.95
_WIDE = 1 << 40


def _classes() -> np.ndarray:
    """Per byte: 0 small letter, 1 capital, 2 digit, 3 white space, 4 other ASCII, 5 beyond ASCII."""
    out = np.full(256, 4, dtype=np.uint8)
    out[ord("a"):ord("z") + 1], out[ord("A"):ord("Z") + 1], out[ord("0"):ord("9") + 1] = 0, 1, 2
    out[K.SPACES], out[128:] = 3, 5
    return out


_CLASS = _classes()


def _text_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the shares of the hashed trigrams of each row."""
    n = len(offsets) - 1
    out = np.zeros((n, TEXT_INPUTS))
    if len(data) < 3:
        return out
    wide = data.astype(np.uint32)
    grams = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    cell = (grams * np.uint32(0x61C88647)) >> np.uint32(32 - (TEXT_INPUTS - 1).bit_length())
    for i in range(n):
        a, b = offsets[i], offsets[i + 1] - 2
        if b > a:
            out[i] = np.sqrt(np.bincount(cell[a:b], minlength=TEXT_INPUTS) / (b - a))
    return out


def _meta_view(data: np.ndarray, offsets: np.ndarray, sources: list, langs: list) -> np.ndarray:
    """Hashed names and layout counts of each row; none of it depends on which words stand there."""
    n = len(offsets) - 1
    out = np.zeros((n, 2 * NAME_INPUTS + 10))
    kinds = _CLASS[data]
    for i in range(n):
        for at, name in ((0, sources[i]), (NAME_INPUTS, langs[i])):
            if name is not None:
                out[i, at + zlib.crc32(str(name).encode()) % NAME_INPUTS] = 1.0
        own = kinds[offsets[i]:offsets[i + 1]]
        size = max(1, len(own))
        share = np.bincount(own, minlength=6) / size
        lines = 1 + np.count_nonzero(data[offsets[i]:offsets[i + 1]] == 10)
        spaces = share[3] * size
        out[i, 2 * NAME_INPUTS:] = [*share, np.log1p(size) / 10, np.log1p(lines) / 5, np.log1p(size / lines) / 10,
                                    np.log1p(size / (1 + spaces)) / 5]
    return out


def _views(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    sources, langs = batch.column("source").to_pylist(), batch.column("lang").to_pylist()
    for start, stop, data, offsets in K.blocks(K.utf8_column(batch.column("text"))):
        yield (start, stop, _text_view(data, offsets), _meta_view(data, offsets, sources[start:stop], langs[start:stop]))


def _sample_views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop, text, meta in _views(batch):
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(start, stop - start), batch.column("part").slice(start, stop - start),
                 pa.array(list(text), pa.list_(pa.float64())), pa.array(list(meta), pa.list_(pa.float64()))],
                names=["label", "part", "text_view", "meta_view"])


class QualityModel:
    """Weights of both views and of their calibrated combination."""

    def __init__(self, text: tuple[np.ndarray, float], meta: tuple[np.ndarray, float], joint: tuple[np.ndarray, float]):
        self.text, self.meta, self.joint = text, meta, joint

    def scores(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        def sigmoid(x):
            return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))

        margins = [np.clip(view @ w + b, -20, 20) for view, (w, b) in ((text, self.text), (meta, self.meta))]
        both = margins[0] * self.joint[0][0] + margins[1] * self.joint[0][1] + self.joint[1]
        return np.stack([sigmoid(margins[0]), sigmoid(margins[1]), sigmoid(both)])


def _margin(model, view: str):
    """The model's clipped log-odds for a row's view."""
    raw = vector_to_array(F.col(f"raw_{view}"))[1]
    return F.greatest(F.lit(-20.0), F.least(F.lit(20.0), raw))


def _judge(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, text, meta in _views(batch):
                of_text, of_meta, _ = shared.value.scores(text, meta)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, stop - start), pa.array(of_text), pa.array(of_meta)],
                                                 names=["doc_id", "of_text", "of_meta"])
    return run


def _lent(texts: DataFrame, known: DataFrame, weights: dict, lent_rows: int, turn: int) -> DataFrame:
    """The rows that the views lend each other: doc_id, for_text and for_meta (labels, null: not lent).

    All of ``texts`` is judged; of the documents that are not ``known`` of which a view is sure, about ``lent_rows`` for
    each label, by a hash of the id.  Only ids and labels are joined, never texts.
    """
    model = QualityModel(weights["text"], weights["meta"], (np.zeros(2), 0.0))
    shared = texts.sparkSession.sparkContext.broadcast(model)
    kind = texts.schema["doc_id"].dataType.simpleString()
    sure = {view: F.when(F.col(f"of_{view}") >= SURE, 1).when(F.col(f"of_{view}") <= 1 - SURE, 0) for view in ("text", "meta")}
    judged = texts.mapInArrow(_judge(shared), f"doc_id {kind}, of_text double, of_meta double").select(
        "doc_id", sure["meta"].alias("for_text"), sure["text"].alias("for_meta")).where("for_text is not null or for_meta is not null")
    judged = staged(judged.groupBy("doc_id").agg(F.min("for_text").alias("for_text"), F.min("for_meta").alias("for_meta")).join(
        known.select("doc_id"), "doc_id", "left_anti"), "judged")
    kinds = [(name, label) for name in ("for_text", "for_meta") for label in (0, 1)]
    counts = judged.agg(*(F.count(F.when(F.col(name) == label, 1)) for name, label in kinds)).first()
    place = F.expr(f"pmod(xxhash64(doc_id, {100 + turn}), {_WIDE}L)")

    def chosen(name: str):
        out = F.lit(None).cast("int")
        for (own, label), n in zip(kinds, counts, strict=True):
            if own == name:
                share = _WIDE if n <= lent_rows else _WIDE * lent_rows // n
                out = F.when((F.col(name) == label) & (place < share), label).otherwise(out)
        return out.alias(name)

    return judged.select("doc_id", chosen("for_text"), chosen("for_meta")).where("for_text is not null or for_meta is not null")


def fit_quality(docs: DataFrame, labels: DataFrame, *, labelled_rows: int = LABELLED_ROWS, lent_rows: int = LENT_ROWS,
                rounds: int = ROUNDS) -> QualityModel:
    """Co-train on about ``labelled_rows`` labelled rows and what the views lend each other of all others, none held out.

    ``docs`` has doc_id, text, source and lang, ``labels`` doc_id and label (0/1).  Rows without a doc_id
    are scored later but not learned from; of several rows with one doc_id that are lent, one is.
    With one label only, or none, every score is that label's share (0.5 without any).
    """
    known = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("label").cast("double").alias("label"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"),
                        F.col("lang").cast("string").alias("lang")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    eligible = known.where(~held_out(F.col("doc_id")))
    total = eligible.count()
    if total > labelled_rows:
        eligible = eligible.where(F.expr(f"pmod(xxhash64(doc_id, 17), {_WIDE}L) < {_WIDE * labelled_rows // total}L"))

    def views(rows: DataFrame, name: str) -> DataFrame:
        seen = rows.select("label", "part", "text", "source", "lang").mapInArrow(
            _sample_views, "label double, part long, text_view array<double>, meta_view array<double>")
        return staged(seen, name).select("label", "part", array_to_vector("text_view").alias("text"), array_to_vector("meta_view").alias("meta"))

    # at most about labelled_rows ids and labels, so this side is always small
    sample = staged(eligible, "sample").withColumn("part", F.expr("pmod(xxhash64(doc_id, 23), 5)"))
    labelled = views(texts.join(F.broadcast(sample), "doc_id"), "views")
    n, ones, fit_n, fit_ones = labelled.agg(
        F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0)), F.count(F.when(F.col("part") > 0, 1)),
        F.coalesce(F.sum(F.when(F.col("part") > 0, F.col("label"))), F.lit(0.0))).first()
    if ones in (0, n) or fit_ones in (0, fit_n):
        odds = float(np.log(max(ones / n, 1e-9) / max(1 - ones / n, 1e-9))) if n else 0.0
        empty = (np.zeros(TEXT_INPUTS), 0.0), (np.zeros(2 * NAME_INPUTS + 10), 0.0)
        return QualityModel(*empty, (np.zeros(2), odds))

    def fit(train: DataFrame, view: str):
        return LogisticRegression(featuresCol=view, labelCol="label", weightCol="weight", regParam=0.001, maxIter=40,
                                  rawPredictionCol=f"raw_{view}", probabilityCol=f"prob_{view}",
                                  predictionCol=f"pred_{view}").fit(train)

    base = labelled.where("part > 0").select("label", F.lit(1.0).alias("weight"), "text", "meta")
    train = {"text": base, "meta": base}
    models = {view: fit(train[view], view) for view in train}
    for turn in range(rounds):
        now = {view: (m.coefficients.toArray(), m.intercept) for view, m in models.items()}
        # at most about 4 x lent_rows ids
        lent = _lent(texts, known, now, lent_rows, turn)
        both = F.coalesce("for_text", F.lit(2)) + 3 * F.coalesce("for_meta", F.lit(2))  # 2: not lent to this view
        rows = texts.join(F.broadcast(lent.select("doc_id", F.lit(0.0).alias("label"), both.cast("long").alias("part"))), "doc_id")
        given = views(rows.dropDuplicates(["doc_id"]), "lent")
        own = {"text": F.col("part") % 3, "meta": F.floor(F.col("part") / 3)}
        for view in models:
            train[view] = base.unionByName(given.where(own[view] < 2).select(
                own[view].cast("double").alias("label"), F.lit(0.5).alias("weight"), "text", "meta"))
        models = {view: fit(train[view], view) for view in train}
    check = models["meta"].transform(models["text"].transform(labelled.where("part = 0"))).select(
        "label", F.lit(1.0).alias("weight"), array_to_vector(F.array(_margin(models["text"], "text"), _margin(models["meta"], "meta"))).alias("joint"))
    sides = check.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    joint = (np.array([0.5, 0.5]), 0.0)
    if 0 < sides[1] < sides[0]:
        fitted = fit(check, "joint")
        joint = (fitted.coefficients.toArray(), fitted.intercept)
    weights = {view: (m.coefficients.toArray(), m.intercept) for view, m in models.items()}
    return QualityModel(weights["text"], weights["meta"], joint)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, text, meta in _views(batch):
                scores = shared.value.scores(text, meta)
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(start, stop - start), *(pa.array(x) for x in scores)],
                                                 names=["row", "text_score", "meta_score", "score"])
    return run


def score_quality(docs: DataFrame, model: QualityModel, *, carry: list[str]) -> DataFrame:
    """The ``carry`` columns of every row with text_score, meta_score and the combined ``score`` (0 to 1, higher: better).

    Null texts score as empty ones; null sources and languages add nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), F.col("text").cast("string").alias("text"),
                         F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(_score(shared), f"row {kind}, text_score double, meta_score double, score double").select(
        "row.*", "text_score", "meta_score", "score")
