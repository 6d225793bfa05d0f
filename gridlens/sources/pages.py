"""Landed API pages -> records.

Each landed file is one page envelope ``{"response": {"total": "N", "data": [...]}}``
(``total`` arrives as text).  Pages of one request live in one folder; the
fetcher names files by zero-padded offset, so (page offset, position in page) is
the arrival order.  A page that cannot be parsed, or that lacks its envelope, fails the job:
its records must not be lost in silence.  A page is capped by the API's page size (5,000 records), so
one file is one bounded row before the explode.

The fetch loop asks for offset 0, moves on by the records it got, and stops at a page that
reaches that page's total or is empty.  ``page_loop`` replays it over what has landed: pages behind
the stop (left over from an earlier, longer run) are ignored, and what is missing or repeated in front of it
is measured.  The replay moves (request, offset, size, total) only, never records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlens.schemas import page_schema

MAX_PAGE_SIZE = 5000


def page_file_name(offset: int) -> str:
    return f"offset={offset:012d}.json"


def read_page_files(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """One row per page: request folder, file, page offset, total (text) and the record array."""
    df = (spark.read.schema(page_schema(list(fields))).option("multiLine", True).option("mode", "FAILFAST").json(path)
          .select(F.col("_metadata.file_path").alias("file"), "response"))
    return df.select(
        F.regexp_extract("file", r"^(.*)/[^/]+$", 1).alias("request"),
        "file",
        page_offset().alias("page"),
        F.col("response.total").alias("total"),
        page_records().alias("data"))


def page_offset() -> Column:
    """The offset in a page's file name; a file without one fails the job."""
    return F.coalesce(F.nullif(F.regexp_extract("file", r"offset=(\d+)", 1), F.lit("")).cast("long"), F.raise_error(
        F.concat(F.lit("page file without an offset: "), F.col("file"))).cast("long"))


def page_records() -> Column:
    """The record array of a page's ``response``; a page without one fails the job."""
    return F.coalesce("response.data", F.raise_error(
        F.concat(F.lit("page without response.data: "), F.col("file"))).cast("void"))


def page_loop(pages: DataFrame) -> DataFrame:
    """The fetch loop over the landed pages: one row per page, without its records.

    ``reach`` is the offset behind the furthest record of the pages before; ``stops`` marks a page
    at which the loop ends; ``read`` is false for the pages behind such a page.  ``missing`` records lie between
    ``reach`` and a page that is read, ``repeated`` ones have landed twice.  A request has as many
    rows here as it has pages, so its window is small however many records landed."""
    rows = pages.select("request", "file", "page", F.size("data").cast("long").alias("size"), F.col("total").cast("long").alias("total"))
    order = Window.partitionBy("request").orderBy("page", "file")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("page") + F.col("size")
    rows = rows.withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0).cast("long")))
    rows = rows.withColumn("stops", (F.greatest(F.col("reach"), end) >= F.col("total")) | (F.col("size") == 0))
    rows = rows.withColumn("read", ~F.coalesce(F.bool_or("stops").over(before), F.lit(False)))
    zero = F.lit(0).cast("long")
    return (rows.withColumn("missing", F.when(F.col("read"), F.greatest(F.col("page") - F.col("reach"), zero)).otherwise(zero))
            .withColumn("repeated", F.when(F.col("read"), F.greatest(F.least(F.col("reach"), end) - F.col("page"), zero)).otherwise(zero)))


def page_completeness(pages: DataFrame) -> DataFrame:
    """Per request: pages that the loop reads and stale ones, records landed, the announced total, records
    missing or repeated in front of the stop, whether the loop stopped, and whether all records are there once."""
    read = F.col("read")
    return (page_loop(pages).groupBy("request")
            .agg(F.count_if(read).alias("pages"), F.count_if(~read).alias("stale_pages"),
                 F.sum(F.when(read, F.col("size")).otherwise(0)).cast("long").alias("landed"),
                 F.max_by("total", F.when(read, F.struct("page", "file"))).alias("total"),
                 F.sum("missing").alias("missing"), F.sum("repeated").alias("repeated"),
                 F.coalesce(F.bool_or(F.when(read, F.col("stops"))), F.lit(False)).alias("loop_stopped"))
            .withColumn("complete", F.col("loop_stopped") & (F.col("missing") == 0) & (F.col("repeated") == 0)
                        & (F.col("landed") >= F.col("total"))))


def check_complete(pages: DataFrame) -> None:
    """Raise unless every request's loop stopped, with no record missing or repeated before the stop."""
    bad = page_completeness(pages).where("not loop_stopped or missing > 0 or repeated > 0").limit(5).collect()
    if bad:
        raise ValueError("incomplete landing: " + "; ".join(
            f"{r['request']} has {r['landed']} of {r['total']} records, {r['missing']} missing and {r['repeated']} repeated "
            "between its pages" for r in bad))


def loop_records(pages: DataFrame) -> DataFrame:
    """The records of the pages that the loop reads, tagged with arrival (page file, offset, position).

    The stop of every request is found on the narrow replay and joined back (one row per request), so
    record arrays are not shuffled where that table is small."""
    # by (offset, file), the order of the replay, so that equal offsets are parted as it parts them
    stops = page_loop(pages).where("read").groupBy("request").agg(F.max(F.struct("page", "file")).alias("last"))
    known = pages.join(stops, "request").where(F.struct("page", "file") <= F.col("last"))
    return (known.select("request", "file", "page", F.posexplode("data").alias("pos", "rec"))
            .select("request", "file", "page", "pos", "rec.*"))


def read_pages(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """The records that the fetch loop would have yielded from the landed pages."""
    return loop_records(read_page_files(spark, path, fields))


def request_slice(records: DataFrame, *, start: str, end: str,
                  facets: dict[str, Sequence[str]] | None = None,
                  ordered: bool = True) -> DataFrame:
    """The selection the API applies for a request: facet IN lists, inclusive
    period bounds (text compare on zero-padded ISO periods), period ascending.

    ``ordered=False`` skips the sort (a distributed range sort) where the order
    is not needed, e.g. before a keyed merge that carries explicit arrival order."""
    out = records
    for name, values in (facets or {}).items():
        out = out.where(F.col(f"`{name}`").isin(list(values)))
    out = out.where(F.col("period").between(F.lit(start), F.lit(end)))
    return out.orderBy("period") if ordered else out


def hourly_bounds(start, end) -> tuple[str, str]:
    """Hourly requests run from ``start T00`` to ``end T23``."""
    return f"{start}T00", f"{end}T23"
