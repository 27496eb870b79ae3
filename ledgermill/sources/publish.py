"""Batch publish of raw files that goes on where an earlier one stopped.

A ledger holds, for each raw file, how many of its records have been delivered. Files are published in
the order of their names, some at a time; what a step has delivered is entered only once all of it is.
A publish that dies repeats the files of its last step and leaves no gap; what it repeats is removed
as redelivery by the dedup of Silver. A cap on records cuts inside a file, and the next publish starts at
the record after it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.schema import PAYLOAD_FIELDS
from ledgermill.session import list_paths
from ledgermill.sources import raw, tables

LEDGER_SCHEMA = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("delivered", T.LongType())]
)
# Files are taken together until they have about this many records.
STEP_RECORDS = 10_000_000


@dataclass(frozen=True)
class Part:
    """Records ``begin`` to ``end`` of a file."""

    file: str
    begin: int
    end: int


def delivered(spark: SparkSession, ledger: str) -> dict[str, int]:
    """Records of each file that have been delivered."""
    rows = tables.read_log(spark, ledger, LEDGER_SCHEMA)
    return {r.file: r.n for r in rows.groupBy("file").agg(F.max("delivered").alias("n")).collect()}


def _files(spark: SparkSession, path: str) -> list[str]:
    """A file, or the files of a folder, by name."""
    inside = list_paths(spark, f"{path.rstrip('/')}/*")
    names = [f for f in inside if not f.rsplit("/", 1)[1].startswith(("_", "."))]
    return sorted(names or list_paths(spark, path))


def _numbered(records: DataFrame) -> DataFrame:
    """``place`` of each record in its file.

    Partitions of the scan hold their splits' records in order; what the splits before hold is one number
    for each split.
    """
    tagged = records.select(
        "*",
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
    )
    splits = tagged.groupBy(F.col("split").alias("s")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n")
    )
    before = F.sum("n").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    starts = splits.withColumn("before", F.coalesce(before, F.lit(0)))
    return tagged.join(starts, F.col("split") == F.col("s")).withColumn(
        "place", F.col("before") + F.col("at") - F.col("first")
    )


def _steps(
    spark: SparkSession, files: list[str], done: dict[str, int], limit: int, step_records: int
) -> Iterator[list[Part]]:
    """What is still to be delivered, some files at a time."""
    left, step, size = limit, [], 0
    for file in files:
        n = raw.read_raw_csv(spark, file).count()
        begin = done.get(file, 0)
        end = min(n, begin + left) if limit else n
        if end > begin:
            step.append(Part(file, begin, end))
            size += end - begin
            left -= end - begin
        if step and (size >= step_records or limit and not left):
            yield step
            step, size = [], 0
        if limit and not left:
            return
    if step:
        yield step


def _records(spark: SparkSession, part: Part) -> DataFrame:
    numbered = _numbered(raw.with_metadata(spark, part.file))
    inside = numbered.filter((F.col("place") >= part.begin) & (F.col("place") < part.end))
    return inside.select(PAYLOAD_FIELDS)


def publish(
    spark: SparkSession,
    path: str,
    ledger: str,
    send: Callable[[DataFrame], None],
    limit: int = 0,
    max_days: int = 0,
    step_records: int = STEP_RECORDS,
) -> int:
    """Deliver the records of ``path`` that the ledger lacks, at most ``limit`` (0: all); how many they were.

    ``send`` writes a frame of messages. ``max_days`` keeps only messages of the first event days; the
    others count as delivered.
    """
    total = 0
    for step in _steps(spark, _files(spark, path), delivered(spark, ledger), limit, step_records):
        rows = _records(spark, step[0])
        for part in step[1:]:
            rows = rows.unionByName(_records(spark, part))
        send(raw.to_messages(raw.first_days(rows, max_days)))
        entries = spark.createDataFrame([(part.file, part.end) for part in step], LEDGER_SCHEMA)
        tables.append_log(entries.coalesce(1), ledger)
        total += sum(part.end - part.begin for part in step)
    return total
