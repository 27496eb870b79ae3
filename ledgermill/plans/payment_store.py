"""Typed payments kept by event day and, within a day, in buckets of the row key.

Equal keys fall on equal days and into equal buckets, so one exchange when a batch is taken in is the last
one: removing copies over all batches, the uniqueness check and merging a day's files read the buckets
where they lie. Batches may be taken in again or overlap, since copies are removed on reading.

The table is plain Parquet in a folder; the number of buckets is kept next to it. The session's catalog
only gets a name for the folder, so any session can open it.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager
from datetime import date
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators import quality, silver
from ledgermill.schema import SILVER_SCHEMA, STEP_EPOCH
from ledgermill.session import full_path, path_exists
from ledgermill.sources import tables

KEY = "row_id"
DAY = "tx_date"
# The catalog puts the partition column last.
STORED = [name for name in SILVER_SCHEMA.fieldNames() if name != DAY] + [DAY]
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def shuffle_number(spark: SparkSession) -> int:
    """Partitions that a shuffle of this session starts with."""
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    adaptive = spark.conf.get("spark.sql.adaptive.enabled") == "true"
    chosen = spark.conf.get(first, None) if adaptive else None
    return int(chosen or spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """Buckets of a day, None before the first batch."""
    layout = f"{path.rstrip('/')}/layout"
    if not path_exists(spark, f"{layout}/_SUCCESS"):
        return None
    return spark.read.schema("buckets INT").parquet(layout).first().buckets


def _open(spark: SparkSession, path: str, buckets: int) -> str:
    """Name of the table in this session, its days as they now are in the folder."""
    # The catalog takes relative paths as below its own warehouse.
    rows = full_path(spark, f"{path.rstrip('/')}/rows")
    name = f"payments_{sha256(rows.encode()).hexdigest()[:24]}"
    columns = ", ".join(f"{f} {SILVER_SCHEMA[f].dataType.simpleString()}" for f in STORED)
    location = rows.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({DAY}) "
        f"CLUSTERED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    if path_exists(spark, rows):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return name


def take_in(rows: DataFrame, path: str, buckets: int | None = None) -> None:
    """Add a batch of typed payments, copies included.

    ``buckets`` counts for the first batch only; without it the session's number of shuffle partitions is
    taken. Copies within the batch are removed first, at most one row a key leaving each task, so a payment
    redelivered without end loads no task. The shuffle of that step deals rows by the same hash as the
    buckets: where its number is a multiple or a part of theirs each task already holds whole buckets, or
    parts of one, and only otherwise are rows dealt once more.
    """
    spark = rows.sparkSession
    known = bucket_count(spark, path)
    if known is None:
        known = buckets or shuffle_number(spark)
        layout = spark.createDataFrame([(known,)], "buckets INT").coalesce(1)
        layout.write.mode("overwrite").parquet(f"{path.rstrip('/')}/layout")
    name = _open(spark, path, known)
    kept = silver.dedup(rows.select(SILVER_SCHEMA.fieldNames()))
    tasks = shuffle_number(spark)
    if tasks % known and known % tasks:
        kept = kept.repartition(known, KEY)
    kept.select(STORED).write.insertInto(name)


def take_in_bronze(
    labelled: DataFrame, path: str, buckets: int | None = None, step_epoch: str = STEP_EPOCH
) -> None:
    """``take_in`` of the valid ones among labelled records."""
    take_in(silver.to_silver(labelled, step_epoch), path, buckets)


def read_batches(
    spark: SparkSession, path: str, start: str | date | None = None, end: str | date | None = None
) -> DataFrame:
    """What all batches hold, copies of different batches included; of all days without ``start``."""
    buckets = bucket_count(spark, path)
    if buckets is None:
        return spark.createDataFrame([], SILVER_SCHEMA)
    rows = spark.table(_open(spark, path, buckets)).select(SILVER_SCHEMA.fieldNames())
    return silver.event_days(rows, start, end) if start else rows


def read_payments(
    spark: SparkSession, path: str, start: str | date | None = None, end: str | date | None = None
) -> DataFrame:
    """One row per payment, as ``silver.dedup`` of all batches gives, without an exchange."""
    return silver.dedup(read_batches(spark, path, start, end))


def write_silver_days(
    spark: SparkSession, path: str, silver_path: str, start: str | date | None = None, end: str | date | None = None
) -> None:
    """Replace days of Silver from the store: Bronze is not parsed again, and nothing is shuffled.

    Each bucket becomes a file of its day, so a day with a third of all rows is written by all tasks.
    """
    tables.write_silver(read_payments(spark, path, start, end), silver_path, many_days=False)


def repeated_keys(spark: SparkSession, path: str) -> DataFrame:
    """``quality.unique`` on the row keys of all batches: how many came in more than one.

    Keys are counted where they lie; only one row of counts leaves each task.
    """
    return quality.unique(read_batches(spark, path), KEY, key_local=True)


def merge_batches(spark: SparkSession, path: str, days: Iterable[date]) -> None:
    """Replace the files that batches left of some days by one for each bucket, without copies.

    Nothing is shuffled. A day is replaced when all of it is written; no batch with rows of these days
    may be taken in meanwhile.
    """
    buckets, wanted = bucket_count(spark, path), sorted(set(days))
    if buckets is None or not wanted:
        return
    rows = read_batches(spark, path).filter(F.col(DAY).isin(wanted))
    with _replacing_days(spark):
        silver.dedup(rows).select(STORED).write.insertInto(_open(spark, path, buckets), overwrite=True)


@contextmanager
def _replacing_days(spark: SparkSession):
    """Overwrite only days that are written; inserts into a table heed no option of the writer."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
