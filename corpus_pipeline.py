"""From raw documents to packed training sequences, one written stage after another.

Stages decide about rows, not about doc_ids: null ids are judged like any other, and different texts under one id
are different documents.  A stage reads what the one before it has written, so that stage's intermediates are
removed when the next one starts.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm import langid
from gridlens.llm.catalog import TOKENIZER
from gridlens.llm.common import remove_folders, staged, staged_folders, table
from gridlens.llm.decontamination import without_items
from gridlens.llm.neardup import near_duplicates
from gridlens.llm.packing import pack_documents
from gridlens.llm.substrings import remove_repeats
from gridlens.session import checkpoint_dir

#: A text of whose n-grams the best language knows less than this is in none that was learned.
LEAST_LANGUAGE_SCORE = 0.25
#: Of a language learned from so little that its own other rows know less, this part of what they know is asked.
REACH_PART = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; null texts and texts without letters go."""
    filters = langid.fit_filters(docs)
    judged = langid.identify_languages(docs, filters, carry=docs.columns)
    least = F.lit(LEAST_LANGUAGE_SCORE)
    for lang, reach in zip(filters.languages, filters.reach, strict=True):
        if REACH_PART * reach < LEAST_LANGUAGE_SCORE:
            least = F.when(F.col("lang_pred") == lang, REACH_PART * reach).otherwise(least)
    return judged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= least)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that with the smallest doc_id (rows without an id come last, equal ids in table order).

    Every row is a document of its own: repeated rows are copies of each other, rows without words stay."""
    rows = staged(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.monotonically_increasing_id().alias("uid")), "rows")
    groups = staged(near_duplicates(rows.select(F.col("uid").alias("doc_id"), F.col("row.text").alias("text")), words_per_shingle=5, percent=80)
                    .select(F.col("doc_id").alias("uid"), "component_id"), "groups")
    large = groups.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    members = groups.join(large, "component_id").join(rows.select("uid", F.col("row.doc_id").alias("id")), "uid")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "uid")).alias("first"))
    leave = members.join(first, "component_id").where("uid <> first.uid").select("uid")
    return rows.join(leave, "uid", "left_anti").select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the stretches that repeat; a document of which nothing is left goes (null and empty texts stay).

    A character that a cut splits is dropped with it; n_chars is counted anew.
    """
    cut = remove_repeats(docs)
    plain = F.col("kept").cast("string")
    text = F.when(F.size("spans") == 0, plain).otherwise(F.regexp_replace(F.make_valid_utf8(plain), "\ufffd", ""))
    out = cut.where("octet_length(kept) > 0 or n_bytes = 0").withColumn("text", text)
    columns = [F.col("text") if c == "text" else
               F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("row.n_chars")).alias(c) if c == "n_chars" else
               F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return out.select(*columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; null and wordless texts hold none."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their token ids and their places in the sequences; a null text is empty."""
    return pack_documents(docs, TOKENIZER, keep_ids=True)


#: Rows of whole texts that go to a Python worker and back at once: executors hold such batches beside the heap.
ARROW_ROWS, _ARROW = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Intermediates of the stage that ran last.
_behind: list[str] = []


def _stage(function):
    """The stage, which first removes the intermediates of the stage before, unless ``docs`` still reads them.

    From then on the session passes ``ARROW_ROWS`` rows at once to Python at most."""
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(_ARROW)) <= ARROW_ROWS:
            spark.conf.set(_ARROW, str(ARROW_ROWS))
        read = docs.inputFiles()
        if not any(folder.split(":")[-1] in file for folder in _behind for file in read):
            remove_folders(spark, _behind)
        before = set(staged_folders())
        out = function(spark, docs, sf_dir)
        _behind[:] = [f for f in staged_folders() if f not in before]
        return out
    return run


STAGES = [(name, _stage(function)) for name, function in (
    ("language ID", identify_language), ("near-duplicates", drop_near_duplicates), ("suffix-array dedup", cut_repeats),
    ("decontamination", drop_contaminated), ("packing", pack))]

#: Learned languages, sketches and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again by the next."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if i:
            remove_folders(spark, [f"{folder}/{i - 1}"])  # read by the stage that has just been written
    remove_folders(spark, _behind)
    _behind.clear()
    return docs
