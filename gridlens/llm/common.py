"""What the operators share on the Spark side: table access and staged intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.session import checkpoint_dir

SPLIT_MODULUS = 5
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class LlmQuery:
    """One registered query: its Spark builder and, where SQL can say it, its SQL twin."""

    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders of staged intermediates of this driver, oldest first.
_folders: list[str] = []


def staged_folders() -> list[str]:
    return list(_folders)


def remove_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders whose tables nothing will read again."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if folder in _folders:
            _folders.remove(folder)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate into the shared checkpoint folder and read it back.

    Later steps then start from files that every executor can read, so a lost
    executor costs only the tasks that ran on it, and a result used twice is
    computed once.  The shuffle files that led to it are no longer needed and go when
    the write ends (a session setting, held while it lasts: write from one thread at a time).
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    path = f"{folder}/{name}"
    _folders.append(folder)
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: the measure for salts and rank buckets."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id) -> F.Column:
    """True for rows that no model may learn from: crc32 of the id's text divides by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % SPLIT_MODULUS == 0, F.lit(False))
