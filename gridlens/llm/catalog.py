"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm import cotraining, decontamination, langid, lexical, linededup, neardup, sharding, toxicity, urlfilter
from gridlens.llm.alignment import align_tokenizers
from gridlens.llm.common import LlmQuery, held_out, table
from gridlens.llm.packing import pack_documents
from gridlens.llm.substrings import remove_repeats
from gridlens.llm.topk import exact_top_k, quantised

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER).drop("ids")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("v"))
    return exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op3_interleaved_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("row.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"), urlfilter.HOST_RULES + urlfilter.WORD_RULES)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = langid.identify_languages(docs, langid.fit_filters(docs), carry=["doc_id"])
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=4, percent=80)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = cotraining.score_quality(docs, cotraining.fit_quality(docs, labels), carry=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text_score", "meta_score", "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score_toxicity(docs, toxicity.fit_machine(docs, labels), carry=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_tokenizers(table(spark, sf_dir, "documents"), TOKENIZER, PIECE_MODEL)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = linededup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_TOPK_SQL = """
WITH parts AS (
  SELECT row_number() OVER () AS row, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (SELECT row, vec_id, i, CAST(floor(1024 * x) AS BIGINT) AS v FROM parts),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, c.row, CAST(sum(q.v * c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.i = c.i AND q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

QUERIES: dict[str, LlmQuery] = {
    "op1_packing": LlmQuery(op1_packing),
    "op2_exact_topk": LlmQuery(op2_exact_topk, _TOPK_SQL),
    "op3_interleaved_sharding": LlmQuery(op3_interleaved_sharding, sharding.SQL),
    "op4_suffix_dedup": LlmQuery(op4_suffix_dedup),
    "op5_decontamination": LlmQuery(op5_decontamination),
    "op6_url_filter": LlmQuery(op6_url_filter, urlfilter.sql_twin()),
    "op7_language_id": LlmQuery(op7_language_id),
    "op8_near_duplicates": LlmQuery(op8_near_duplicates, neardup.SQL),
    "op9_quality": LlmQuery(op9_quality),
    "op10_toxicity": LlmQuery(op10_toxicity),
    "op11_lexical_search": LlmQuery(op11_lexical_search, lexical.SQL),
    "op12_tokenizer_alignment": LlmQuery(op12_tokenizer_alignment),
    "op13_line_dedup": LlmQuery(op13_line_dedup, linededup.SQL),
}
