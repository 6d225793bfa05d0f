"""Row-adjacent window operators over hourly series.

Series are ordered by ``period_utc`` inside each partition (respondent, plus the
series name where several series share a table).  Offsets are *rows*, not
hours: a gap in the data yields one multi-hour step, as in the reference.

Scale note: a window over a whole series has as many tasks as there are series.
:func:`with_tails` cuts series into chunks of time instead, so tasks grow with the
covered time: a row looks back inside its chunk, and for what lies before the chunk
into a tail of at most ``n`` rows that is carried over from the chunks before.  Only
one row per chunk, with its tail, is ordered by series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "month"
_CHUNK, _AT, _TAIL, _BEFORE, _ROWS = "_chunk", "_at", "_tail", "_rows_before", "_rows"
CARRIED = [_CHUNK, _AT, _TAIL, _BEFORE, _ROWS]


def series_window(partition: Sequence[str] = ("respondent",), order: str = "period_utc"):
    return Window.partitionBy(*partition).orderBy(order)


def with_tails(rows: DataFrame, value: str, n: int, partition: Sequence[str] = ("respondent",),
               order: str = "period_utc", chunk: str = CHUNK) -> DataFrame:
    """``rows`` with what a look-back of up to ``n`` rows needs (the :data:`CARRIED` columns).

    ``chunk`` is a unit of date_trunc.  A chunk holds at least one row, so the tails of the ``n``
    chunks before hold the ``n`` rows before, however sparse the series is.  ``order`` is unique in a
    series; rows without it or without a series are left out.
    """
    keys = [*partition, _CHUNK]
    dealt = rows.withColumn(_CHUNK, F.date_trunc(chunk, order))
    # said here, not left to the join below, so that both sides of it are alike and share their exchanges
    for key in keys:
        dealt = dealt.where(F.col(key).isNotNull())
    latest = Window.partitionBy(*keys).orderBy(F.desc(order))
    # a null element stays as a struct; collect_list leaves out the rows before the tail
    ends = (dealt.select(*keys, order, F.struct(order, F.col(value).alias("v")).alias("row"))
            .withColumn("from_end", F.row_number().over(latest))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                F.array_sort(F.collect_list(F.when(F.col("from_end") <= n, F.col("row")))).alias("ends")))
    chunks = Window.partitionBy(*partition).orderBy(_CHUNK)
    before = F.flatten(F.collect_list("ends").over(chunks.rowsBetween(-n, -1)))
    tails = ends.select(
        *keys, before.alias("before"), F.sum("n").over(Window.partitionBy(*partition)).alias(_ROWS),
        F.coalesce(F.sum("n").over(chunks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(_BEFORE),
    ).select(*keys, _ROWS, _BEFORE, F.transform(F.slice("before", F.greatest(F.lit(1), F.size("before") - n + 1), n),
                                                lambda x: x["v"]).alias(_TAIL))
    return dealt.withColumn(_AT, F.row_number().over(series_window(keys, order)) - 1).join(tails, keys)


def chunk_window(partition: Sequence[str] = ("respondent",), order: str = "period_utc"):
    return series_window([*partition, _CHUNK], order)


def lag_col(value: str, n: int, w) -> Column:
    """The value ``n`` rows before, over rows of :func:`with_tails`; ``w`` is their :func:`chunk_window`."""
    return F.when(F.col(_AT) >= n, F.lag(F.col(value), n).over(w)).otherwise(
        F.get(_TAIL, F.size(_TAIL) - n + F.col(_AT)))


def carried_part(n: int) -> Column:
    """Those of the ``n`` values before a row that lie before its chunk."""
    missing = n - F.col(_AT)
    return F.when(missing > 0, F.slice(_TAIL, F.greatest(F.lit(1), F.size(_TAIL) - missing + 1), F.greatest(missing, F.lit(0))))


def row_index() -> Column:
    """0-based position of the row in its series."""
    return (F.col(_BEFORE) + F.col(_AT)).cast("long")


def row_count() -> Column:
    """Rows of the series."""
    return F.col(_ROWS)


def hourly_ramp(curve: DataFrame, value: str = "net_load_mwh", partition: Sequence[str] = ("respondent",),
                out: str = "ramp_mwh", chunk: str | None = None) -> DataFrame:
    """abs(v[i] - v[i-1]) between adjacent rows; NULL on each series' first row.

    One window over each series, or over each ``chunk`` of it (a unit of date_trunc) for long ranges."""
    if chunk is None:
        return curve.withColumn(out, F.abs(F.col(value) - F.lag(value, 1).over(series_window(partition))))
    rows = with_tails(curve, value, 1, partition, chunk=chunk)
    return rows.withColumn(out, F.abs(F.col(value) - lag_col(value, 1, chunk_window(partition)))).select(*curve.columns, out)
