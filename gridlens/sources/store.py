"""Keyed upsert into partitioned Parquet, scans, views and counts.

Layout (zero-padded, as the reference's monthly partitions):
``<data_dir>/normalized/<dataset>[/respondent=X]/year=YYYY/month=MM/v=COMMIT/part-*.parquet``.
Outage data has no respondent level.

Upsert = existing rows of the touched partitions  UNION  new rows, then the last
arrival per key wins as a whole row.  The merge is a ``max_by`` aggregation on
the key (partial aggregation collapses copies of a hot key before the shuffle, so a key
repeated in a third of the rows costs no single task more than its share).

Commits are snapshots.  The merged partitions are written once, straight to folders of a new
version that nobody reads yet.  Then one small file, ``_snapshots/<number>.json``, appears by a
rename: it lists the version of every partition, and readers take the snapshot with the highest
number.  A write that fails at any point leaves the snapshot before it, whole; the next commit
tries again, and ``vacuum`` removes folders that no kept snapshot lists.  One writer per dataset at a time:
a commit whose snapshot was overtaken raises ``ConcurrentCommit`` and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.functions.timefmt import iso_offset
from gridlens.operators.curve import duck_curve
from gridlens.schemas import (FUEL_KEYS, FUEL_SCHEMA, OUTAGE_KEYS, OUTAGE_SCHEMA, REGION_KEYS,
                              REGION_SCHEMA)

DATASETS = {
    # name: (schema, key, time column, partitioned by respondent)
    "grid_region_hourly": (REGION_SCHEMA, REGION_KEYS, "period_utc", True),
    "grid_fuel_hourly": (FUEL_SCHEMA, FUEL_KEYS, "period_utc", True),
    "nuclear_facility_daily": (OUTAGE_SCHEMA, OUTAGE_KEYS, "period_date", False),
}

# Arrival order of a row: ingest run (batch), landed page file (zero-padded
# offsets sort in page order inside a request folder; folders break ties between
# requests), page offset, position inside the page.
ARRIVAL = ["batch", "file", "page", "pos"]
_ARRIVAL_TYPES = {"batch": "long", "file": "string", "page": "long", "pos": "long"}


def _arrival_default(c: str) -> F.Column:
    return F.lit("" if _ARRIVAL_TYPES[c] == "string" else 0).cast(_ARRIVAL_TYPES[c])


class ConcurrentCommit(RuntimeError):
    """Another commit came first; the upsert can be run again on the new snapshot."""


def last_arrival(rows: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Latest row per key by the ``arrival`` columns (lexicographic), whole row kept.

    ``max_by`` over the key aggregates partially before the exchange: duplicates of one
    key are collapsed inside each map task.  (Rows hold text, so Spark sorts for it.)"""
    payload = [c for c in rows.columns if c not in keys and c not in arrival]
    order = F.struct(*[F.col(c) for c in arrival])
    merged = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in payload]), order).alias("_row"))
    return merged.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])


def partition_columns(dataset: str) -> list[str]:
    return (["respondent"] if DATASETS[dataset][3] else []) + ["year", "month"]


def with_partitions(df: DataFrame, dataset: str) -> DataFrame:
    time_col = DATASETS[dataset][2]
    return (df.withColumn("year", F.date_format(time_col, "yyyy"))
              .withColumn("month", F.date_format(time_col, "MM")))


def dataset_path(data_dir: str, dataset: str) -> str:
    return f"{data_dir.rstrip('/')}/normalized/{dataset}"


def _read_schema(dataset: str) -> T.StructType:
    schema = DATASETS[dataset][0]
    fields = list(schema.fields)
    return T.StructType(fields + [T.StructField("year", T.StringType()),
                                  T.StructField("month", T.StringType())])


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _remove(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs_path(spark, path)
    fs.delete(hpath, True)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, hpath = _fs_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs_path(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# -- snapshots

KEPT_SNAPSHOTS = 2


def _snapshots(data_dir: str, dataset: str) -> str:
    return f"{dataset_path(data_dir, dataset)}/_snapshots"


def snapshot_numbers(spark: SparkSession, data_dir: str, dataset: str) -> list[int]:
    return [int(n[:-5]) for n in _children(spark, _snapshots(data_dir, dataset)) if n.endswith(".json")]


def read_snapshot(spark: SparkSession, data_dir: str, dataset: str, number: int | None = None) -> tuple[int, dict[tuple[str, ...], str]]:
    """(number, version of each partition) of a snapshot, by default the latest; (0, {}) before the first commit."""
    number = max(snapshot_numbers(spark, data_dir, dataset), default=0) if number is None else number
    if not number:
        return 0, {}
    rows = json.loads(_read_text(spark, f"{_snapshots(data_dir, dataset)}/{number:012d}.json"))
    return number, {tuple(r["partition"]): r["version"] for r in rows}


def _publish(spark: SparkSession, data_dir: str, dataset: str, after: int, versions: dict[tuple[str, ...], str]) -> None:
    """Make ``versions`` the snapshot after number ``after``: written aside, then renamed into place."""
    folder, text = _snapshots(data_dir, dataset), json.dumps([{"partition": p, "version": v} for p, v in sorted(versions.items())])
    fs, aside = _fs_path(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    target = _fs_path(spark, f"{folder}/{after + 1:012d}.json")[1]
    overtaken = max(snapshot_numbers(spark, data_dir, dataset), default=0) != after
    if overtaken or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise ConcurrentCommit(f"{dataset}: snapshot {after + 1} was committed by another writer")


def _partition_path(dataset: str, partition: tuple[str, ...], version: str) -> str:
    names = partition_columns(dataset)
    return "/".join([*(f"{n}={_escaped(v)}" for n, v in zip(names, partition, strict=True)), f"v={version}"])


def _escaped(value: str) -> str:
    """A partition value as Spark writes it in a folder name."""
    return "".join(f"%{ord(c):02X}" if c in '"#%\'*/:=?\\{[]^' or ord(c) < 32 or ord(c) == 127 else c for c in value)


def vacuum(spark: SparkSession, data_dir: str, dataset: str, keep: int = KEPT_SNAPSHOTS) -> int:
    """Remove all but the last ``keep`` snapshots, and the versions that only removed ones list; returns how many."""
    numbers = sorted(snapshot_numbers(spark, data_dir, dataset))
    old, kept = numbers[:-keep], numbers[-keep:]
    listed = [set(read_snapshot(spark, data_dir, dataset, n)[1].items()) for n in numbers]
    gone = set().union(*listed[:len(old)]) - set().union(*listed[len(old):]) if kept else set()
    for n in old:  # the list first: a snapshot must never name a folder that is gone
        _remove(spark, f"{_snapshots(data_dir, dataset)}/{n:012d}.json")
    for partition, version in gone:
        _remove(spark, f"{dataset_path(data_dir, dataset)}/{_partition_path(dataset, partition, version)}")
    return len(gone)


def scan_table(spark: SparkSession, data_dir: str, dataset: str, *, with_partitions_cols=False,
               months: tuple[str, str] | None = None, partitions: Iterable[tuple[str, ...]] | None = None) -> DataFrame:
    """The latest snapshot: declared schema, partition values read as text (``month=04`` stays ``"04"``);
    path-derived year/month are not exposed. ``months=("YYYYMM","YYYYMM")`` and ``partitions`` name
    what is read: only the folders of those partitions are listed and opened."""
    schema, _, _, _ = DATASETS[dataset]
    base = dataset_path(data_dir, dataset)
    versions = read_snapshot(spark, data_dir, dataset)[1]
    wanted = versions.keys() if partitions is None else [p for p in partitions if p in versions]
    if months:
        wanted = [p for p in wanted if months[0] <= p[-2] + p[-1] <= months[1]]
    paths = [f"{base}/{_partition_path(dataset, p, versions[p])}" for p in wanted]
    if not paths:
        df = spark.createDataFrame([], _read_schema(dataset))
    else:
        df = (spark.read.schema(_read_schema(dataset))
              .option("basePath", base).parquet(*paths))
    if months:
        ym = F.concat(F.col("year"), F.col("month"))
        df = df.where(ym.between(F.lit(months[0]), F.lit(months[1])))
    cols = [f.name for f in schema.fields]
    return df.select(*(cols + (["year", "month"] if with_partitions_cols else [])))


def staging_path(spark: SparkSession, data_dir: str) -> str:
    """A fresh folder next to the data (shared storage), never a machine-local one."""
    return f"{data_dir.rstrip('/')}/_staging/{uuid.uuid4().hex}"


def upsert(spark: SparkSession, data_dir: str, dataset: str, new_rows: DataFrame,
           *, batch: int | None = None) -> int:
    """Merge ``new_rows`` into the dataset; returns the row count of the touched partitions.

    ``new_rows`` carry arrival columns ``file``, ``page`` and ``pos`` (and
    optionally ``batch``); without them, rows are taken as one arrival in table order of the
    key (ties then resolve arbitrarily, as for any unordered input)."""
    schema, keys, _, _ = DATASETS[dataset]
    cols = [f.name for f in schema.fields]
    parts = partition_columns(dataset)
    new = new_rows
    for c in ARRIVAL:
        if c not in new.columns:
            new = new.withColumn(c, _arrival_default(c))
    if batch is not None:
        new = new.withColumn("batch", F.lit(batch).cast("long"))
    new = with_partitions(new.select(*cols, *[F.col(c).cast(_ARRIVAL_TYPES[c]).alias(c)
                                              for c in ARRIVAL]), dataset)
    stage = staging_path(spark, data_dir)
    try:
        # the new rows are computed once, and tell which partitions are read and replaced
        new.write.parquet(stage)
        rows = spark.read.schema(new.schema).parquet(stage)
        touched = sorted(tuple(r) for r in rows.select(*parts).distinct().collect())
        if not touched:
            return 0
        number, versions = read_snapshot(spark, data_dir, dataset)
        version = uuid.uuid4().hex
        merged = merged_rows(spark, data_dir, dataset, rows, touched)
        kept = Observation("merged")
        # rebalance: hash by partition values, but AQE splits an oversized (hot)
        # partition over several tasks/files instead of funnelling it into one.
        (merged.observe(kept, F.count(F.lit(1)).alias("rows")).hint("rebalance", *parts).sortWithinPartitions(*parts, *keys)
         .withColumn("v", F.lit(version)).write.mode("append").option("compression", "zstd")
         .partitionBy(*parts, "v").parquet(dataset_path(data_dir, dataset)))
        _publish(spark, data_dir, dataset, number, versions | dict.fromkeys(touched, version))
        vacuum(spark, data_dir, dataset)
        return int(kept.get["rows"])
    finally:
        _remove(spark, stage)  # the staged copy of the new rows; no other copy of anything is in it


def merged_rows(spark: SparkSession, data_dir: str, dataset: str, new: DataFrame, touched: list[tuple[str, ...]]) -> DataFrame:
    """Stored rows of the ``touched`` partitions and the new ones, one row per key: the last arrival's."""
    schema, keys, _, _ = DATASETS[dataset]
    cols = [f.name for f in schema.fields]
    rows = stored_rows(spark, data_dir, dataset, touched).unionByName(new)
    return last_arrival(rows, [*keys], ARRIVAL).select(*cols, *[c for c in partition_columns(dataset) if c not in cols])


def stored_rows(spark: SparkSession, data_dir: str, dataset: str, touched: list[tuple[str, ...]]) -> DataFrame:
    """Stored rows of the ``touched`` partitions, as arrivals older than any new one; nothing else is read."""
    return (scan_table(spark, data_dir, dataset, with_partitions_cols=True, partitions=touched)
            .withColumn("batch", F.lit(-1).cast("long"))
            .withColumn("file", _arrival_default("file"))
            .withColumn("page", _arrival_default("page"))
            .withColumn("pos", _arrival_default("pos")))


def month_range(start, end) -> tuple[str, str]:
    """Year/month partition bounds (``YYYYMM``) of an inclusive date range; the
    half-open UTC end of an hourly slice (end + 1 day, 00:00) never reaches into
    the next month's partition."""
    import datetime as dt
    start = start if isinstance(start, dt.date) else dt.date.fromisoformat(str(start))
    end = end if isinstance(end, dt.date) else dt.date.fromisoformat(str(end))
    return f"{start:%Y%m}", f"{end:%Y%m}"


def register_views(spark: SparkSession, data_dir: str, start=None, end=None) -> dict[str, DataFrame]:
    """Temp views over the stored tables plus the ``ba_duck_curve_hourly`` view.

    With ``start``/``end`` (dates) every view is restricted to the year/month
    partitions of that range, so the scans prune partitions instead of listing and
    reading the whole history; period filters on the views still apply on top."""
    months = month_range(start, end) if start is not None and end is not None else None
    views = {name: scan_table(spark, data_dir, name, months=months) for name in DATASETS}
    views["ba_duck_curve_hourly"] = duck_curve(views["grid_region_hourly"],
                                               views["grid_fuel_hourly"])
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def read_duck_curve(curve: DataFrame, respondent: str) -> DataFrame:
    """A respondent's curve in hour order, with the hours as ISO text."""
    return (curve.where(F.col("respondent") == F.lit(respondent)).orderBy("period_utc")
            .withColumn("period_utc", iso_offset("period_utc")))


VIEW_ORDER = ["grid_region_hourly", "grid_fuel_hourly", "nuclear_facility_daily",
              "ba_duck_curve_hourly"]


def hourly_keys(region: DataFrame, fuel: DataFrame) -> DataFrame:
    """Per (hour, respondent): how many region, demand and fuel rows there are."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    flags = region.select("period_utc", "respondent", one.alias("region"), (F.col("metric_type") == "D").cast("long").alias("demand"),
                          none.alias("fuel")).unionByName(
        fuel.select("period_utc", "respondent", none.alias("region"), none.alias("demand"), one.alias("fuel")))
    return flags.groupBy("period_utc", "respondent").agg(*(F.sum(c).alias(f"{c}_rows") for c in ("region", "demand", "fuel")))


def counts(keys: DataFrame, outage: DataFrame) -> DataFrame:
    """(ord, view_name, row_count) of the four views.  The curve has a row per demand row of an hour that has
    fuel rows too, which the keys tell without joining the two."""
    curve = F.when(F.col("fuel_rows") > 0, F.col("demand_rows")).otherwise(0)
    grid = keys.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in zip(
        ("region", "fuel", "curve"), (F.col("region_rows"), F.col("fuel_rows"), curve), strict=True)))
    names = dict(zip(("region", "fuel", "outage", "curve"), enumerate(VIEW_ORDER), strict=True))

    def row(name, value):
        return F.struct(F.lit(names[name][0]).alias("ord"), F.lit(names[name][1]).alias("view_name"), value.alias("row_count"))

    rows = grid.select(F.inline(F.array(*(row(n, F.col(n)) for n in ("region", "fuel", "curve")))))
    return rows.unionByName(outage.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(row("outage", F.col("n"))))))


def table_counts(views: dict[str, DataFrame]) -> DataFrame:
    """(ord, view_name, row_count) for the four views; ``ord`` is the reference's order."""
    return counts(hourly_keys(views["grid_region_hourly"], views["grid_fuel_hourly"]), views["nuclear_facility_daily"])
