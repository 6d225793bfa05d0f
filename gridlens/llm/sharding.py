"""Sharding by proportional stratified interleaving, on built-in functions alone.

Rows are shuffled within their source by a seeded hash and ranked; the rank divided by
the source's size, shifted by a phase of the source's own, is a number between 0 and 1 at
which every source is spread evenly.  Sorting all rows by it and cutting the order into
equal parts gives shards that each hold every source in proportion, and whose row
counts differ by one at most.

Both rankings are done in buckets whose counts are added up first, so that neither a
source with a third of the rows nor the total order is handled by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.llm.common import shuffle_width

SHARDS, OVERHEAD_BYTES, SEED = 40, 16, "shards-1"


def _unit(text: Column) -> Column:
    """The first 48 bits of a text's MD5 as a whole number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")


def _running(df: DataFrame, keys: list[str], bucket: str, weight: Column, name: str) -> DataFrame:
    """The sum of ``weight`` over all smaller buckets, and over all, per key."""
    per = df.groupBy(*keys, bucket).agg(F.sum(weight).alias("w"))
    order = Window.partitionBy(*keys).orderBy(bucket) if keys else Window.orderBy(bucket)
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return per.select(*keys, bucket, (F.sum("w").over(order) - F.col("w")).alias(name),
                      F.sum("w").over(whole).alias(f"{name}_all"))


def interleave(docs: DataFrame, shards: int = SHARDS, *, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot) for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 16 (a null text has none) and
    ``text_crc32`` its unsigned CRC-32 (null: that of the empty text).  Row counts of
    shards differ by one at most; with fewer rows than shards some stay empty.
    Null sources make one source of their own, null doc_ids are rows like others, and
    repeated rows are each placed.  The outcome depends on rows and seed only.
    """
    spark = docs.sparkSession
    buckets = min(4 * shuffle_width(spark), 8192)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        (F.octet_length(text) + F.lit(OVERHEAD_BYTES)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    # equal rows are counted first: they are interchangeable, and one key's copies stay one row until ranked
    kinds = rows.groupBy("doc_id", "source", "size", "text_crc32").agg(F.count("*").alias("copies"))
    kinds = kinds.withColumn("stratum", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).withColumn(
        "turn", _unit(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    kinds = kinds.withColumn("bucket", F.shiftright(F.col("turn") * buckets, 48).cast("int"))
    ahead = _running(kinds, ["stratum"], "bucket", F.col("copies"), "ahead")
    inner = Window.partitionBy("stratum", "bucket").orderBy("turn", "doc_id", "size", "text_crc32")
    placed = kinds.withColumn("upto", F.sum("copies").over(inner)).join(ahead, ["stratum", "bucket"])
    spread = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).withColumn(
        "rank", F.col("ahead") + F.col("upto") - F.col("copies") + F.col("copy"))
    phase = _unit(F.concat(F.lit(seed), F.lit("/"), F.col("stratum"))).cast("double") / F.lit(float(1 << 48))
    spread = spread.withColumn("at", (F.col("rank").cast("double") + phase) / F.col("ahead_all").cast("double"))
    spread = spread.withColumn("cell", F.least(F.floor(F.col("at") * buckets), F.lit(buckets - 1)).cast("int"))
    before = _running(spread, [], "cell", F.lit(1).cast("long"), "before")
    order = Window.partitionBy("cell").orderBy("at", "stratum", "rank")
    final = spread.withColumn("nth", F.row_number().over(order)).join(before, "cell").withColumn(
        "place", F.col("before") + F.col("nth") - 1)
    shard = F.expr(f"place * {shards} div before_all")
    first = F.expr(f"(shard * before_all + {shards - 1}) div {shards}")
    return final.withColumn("shard", shard).select(
        "doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        (F.col("place") - first).cast("long").alias("slot"))


SQL = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
kinds AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + {OVERHEAD_BYTES} AS size, coalesce('s' || source, 'n') AS stratum,
         ('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT AS turn,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
             lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY turn, doc_id, size, text_crc32) - 1 AS rank,
         count(*) OVER (PARTITION BY stratum) AS n FROM kinds),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY (CAST(rank AS DOUBLE) + CAST(('0x' || substr(md5('{SEED}/' || stratum), 1, 12))::BIGINT AS DOUBLE)
         / 281474976710656.0) / CAST(n AS DOUBLE), stratum, rank) - 1 AS place, count(*) OVER () AS total FROM ranked),
cut AS (SELECT *, place * {SHARDS} // total AS shard FROM ordered)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(shard AS INTEGER) AS shard, CAST(place - (shard * total + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard FROM cut
"""
