"""Language identification by bit-sliced Bloom filters over byte n-grams.

All languages' Bloom filters are stored side by side: one row per filter position,
one bit per language.  The AND of an n-gram's rows is the set of languages that
contain it, so one lookup serves all of them.  A text's per-language popcounts, less
what false positives add on average, decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridlens.llm.common import held_out, staged

GRAM, HASHES, POSITION_BITS = 4, 3, 20
TRAIN_ROWS, GRAMS_PER_LANGUAGE, LEAST_COUNT, LEAST_SHARE = 20_000, 1 << 16, 3, 0.1
#: A language of fewer sampled rows keeps every n-gram, however rare.
FEW_ROWS = 50
UNDETERMINED = "und"


def _block_text(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts with a space before and spaces behind, as one byte array with offsets."""
    parts = [b" " + (t or "").lower().encode("utf-8", "replace") + b"   " for t in texts]
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([0, *map(len, parts)])


def _grams(data: np.ndarray) -> np.ndarray:
    """The code of the four bytes at each position but the last three."""
    out = np.zeros(len(data) - GRAM + 1, dtype=np.uint32)
    for i in range(GRAM):
        out |= data[i:len(out) + i].astype(np.uint32) << np.uint32(8 * i)
    return out


def _text_blocks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    sizes = np.cumsum(np.maximum(1, np.array([len(x.as_buffer()) if x.is_valid else 0 for x in column])))
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit)))
        yield at, column.slice(at, stop - at).to_pylist()
        at = stop


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) sums of a partition, passed on whenever many have gathered."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            grams, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(n)],
                                             names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for start, texts in _text_blocks(batch.column("text")):
            here = langs[start:start + len(texts)]
            for lang in sorted(set(here)):
                data, _ = _block_text([t for t, x in zip(texts, here, strict=True) if x == lang])
                held.setdefault(lang, []).append(np.unique(_grams(data), return_counts=True))
        if sum(len(p[0]) for parts in held.values() for p in parts) > 2_000_000:
            yield from flush()
    yield from flush()


def _position(gram: Column, i: int) -> Column:
    """The i-th filter position of a gram code, the same as in ``_positions``."""
    spun = F.pmod(gram * F.lit(_ODD[i]), F.lit(1 << 32))
    return F.shiftright(spun, 32 - POSITION_BITS).cast("int")


#: Odd multipliers below 2^31, so that the product with a 32-bit code stays in 64 bits.
_ODD = [0x61C88647, 0x45D9F3B3 | 1, 0x2545F491]


def _positions(grams: np.ndarray, i: int) -> np.ndarray:
    return (grams * np.uint32(_ODD[i])) >> np.uint32(32 - POSITION_BITS)


class LanguageFilters:
    """The sliced filters: ``rows`` holds, per position, 64 languages to a word."""

    def __init__(self, languages: list[str], cells: list[tuple[int, int, int]], reach: list[float] | None = None):
        self.languages = languages
        #: Per language, the share of n-grams that rows it was not learned from find in it (0 if there is but one row).
        self.reach = reach or [1.0] * len(languages)
        words = max(1, -(-len(languages) // 64))
        self.rows = np.zeros((1 << POSITION_BITS, words), dtype=np.uint64)
        for position, word, mask in cells:
            self.rows[position, word] = np.uint64(mask & (1 << 64) - 1)
        bits = [(self.rows[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(len(languages))]
        self.false_positive = np.array([float(b.mean()) ** HASHES for b in bits])
        if len(languages) <= 8:
            self.rows = self.rows.astype(np.uint8)

    def shares(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text and language, the corrected share of the text's n-grams in the filter."""
        grams = _grams(data)
        found = self.rows[_positions(grams, 0)]
        for i in range(1, HASHES):
            found &= self.rows[_positions(grams, i)]
        sizes = np.diff(offsets) - GRAM + 1
        for i in range(1, GRAM):
            found[offsets[1:-1] - i] = 0
        kind, out = found.dtype.type, np.zeros((len(sizes), len(self.languages)))
        for i in range(len(self.languages)):
            word, bit = divmod(i, 64)
            hit = (found[:, word] >> kind(bit)) & kind(1)
            counts = np.add.reduceat(hit, offsets[:-1], dtype=np.int64)
            out[:, i] = (counts / sizes - self.false_positive[i]) / max(1e-9, 1 - self.false_positive[i])
        return np.clip(out, 0.0, 1.0)


def _quotas(rows: dict[str, int], most: int) -> dict[str, int]:
    """Rows to take of each language: all where there are few, and equal parts of what is left of ``most`` from the others."""
    quotas, left = {}, most
    for i, lang in enumerate(sorted(rows, key=lambda x: (rows[x], x))):
        quotas[lang] = max(1, min(rows[lang], left // (len(rows) - i)))
        left -= quotas[lang]
    return quotas


def fit_filters(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> LanguageFilters:
    """Filters from about ``train_rows`` labelled, not held-out rows (fewer if there are fewer).

    The sample is drawn per language, so that a language of few rows is learned from all of them.
    A language's filter holds its most frequent n-grams (65,536 at most) that occur three
    times or more in the sample (once, below ``FEW_ROWS`` rows) and at a tenth or more of the rate of the
    language that uses them most.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    spark, languages = docs.sparkSession, sorted(rows)
    quotas = _quotas(rows, train_rows)
    number = F.broadcast(spark.createDataFrame(
        [(x, i, max(1, int(1_000_000 * quotas[x] / rows[x])), LEAST_COUNT if quotas[x] >= FEW_ROWS else 1)
         for i, x in enumerate(languages)], "lang string, i int, share int, least int"))
    if sum(rows.values()) > train_rows:
        # the same row whatever the others are; two equal rows go together
        labelled = labelled.join(number, "lang").where(F.expr("pmod(xxhash64(doc_id, text, 11), 1000000) < share"))
    # each language in two halves, of which one tells how much of the other is known
    halves = labelled.select(F.concat(F.expr("pmod(xxhash64(doc_id, text, 12), 2)"), "lang").alias("lang"), "text")
    counts = halves.mapInArrow(_count, "lang string, gram long, n long").groupBy(
        F.expr("substring(lang, 2)").alias("lang"), "gram").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("lang").startswith("0"), F.col("n")).otherwise(0)).alias("half"))
    counts = staged(counts, "grams")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("size"))
    rates = counts.join(sizes, "lang").withColumn("rate", F.col("n") / F.col("size"))
    top = rates.groupBy("gram").agg(F.max("rate").alias("top"))
    chosen = rates.join(top, "gram").join(number, "lang").where((F.col("n") >= F.col("least")) & (F.col("rate") >= LEAST_SHARE * F.col("top")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    chosen = staged(chosen.withColumn("place", F.row_number().over(order)).where(F.col("place") <= GRAMS_PER_LANGUAGE), "chosen")
    found = chosen.where("half > 0 and half < n").groupBy("lang").agg((F.sum("n") / F.first("size")).alias("reach"))
    reach = {r["lang"]: r["reach"] for r in found.collect()}
    cells = chosen.select(
        F.explode(F.array(*(_position(F.col("gram"), j) for j in range(HASHES)))).alias("position"),
        F.expr("i div 64").cast("int").alias("word"), F.expr("shiftleft(1L, i % 64)").alias("mask"))
    cells = cells.groupBy("position", "word").agg(F.bit_or("mask").alias("mask"))
    return LanguageFilters(languages, [tuple(r) for r in cells.collect()], [reach.get(x, 0.0) for x in languages])


def _predict(shared, carried: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter, model = regex.compile(r"\p{L}"), shared.value
        for batch in batches:
            for start, texts in _text_blocks(batch.column("row").field("text") if carried else batch.column("text")):
                rows = batch.slice(start, len(texts))
                known = [t is not None and letter.search(t) is not None for t in texts]
                if model.languages:
                    shares = model.shares(*_block_text(texts))
                    best = shares.argmax(axis=1)
                    names = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
                    scores = np.where(known, shares.max(axis=1), 0.0)
                else:
                    names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(names), pa.array(scores)],
                                                 names=["row", "lang_pred", "score"])
    return run


def identify_languages(docs: DataFrame, filters: LanguageFilters, *, carry: list[str]) -> DataFrame:
    """The ``carry`` columns of every row with ``lang_pred`` and ``score``.

    ``score`` is the corrected share of the text's n-grams that the predicted language
    knows.  Null texts and texts without a letter are ``und`` with score 0, as is all
    if nothing could be learned; ties go to the alphabetically first language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    source = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), F.col("text").cast("string").alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    carried = "text" in carry and docs.schema["text"].dataType == StringType()  # then it need not go to Python twice
    return source.drop(*["text"] * carried).mapInArrow(_predict(shared, carried), f"row {kind}, lang_pred string, score double").select(
        "row.*", "lang_pred", "score")
