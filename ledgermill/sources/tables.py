"""Silver, quarantine, Gold, metrics and log tables as Parquet folders."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from datetime import date
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgermill.schema import METRICS_SCHEMA, QUARANTINE_SCHEMA, SILVER_SCHEMA
from ledgermill.session import drop_folder, list_paths, path_exists


# Fixed value: folder of rows whose partition value is NULL.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

# Publishes of metrics beyond which the finished ones are merged.
MOST_PUBLISHES = 20


def _replace_partitions(df: DataFrame, path: str, key: str) -> None:
    """Overwrite only the partitions that ``df`` has rows for.

    The writer option leaves the session's own overwrite mode alone.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )


def write_silver(
    silver: DataFrame, path: str, many_days: bool = True, observe: tuple | None = None
) -> None:
    """Replace the event days that ``silver`` holds, and no others.

    Rows come out of the dedup spread by row key. For many days they are first gathered by day, or
    every task would open a file per day; AQE then splits a day larger than the advisory size over
    several tasks, so a day with a third of all rows is no straggler. A single day needs no such
    shuffle. ``observe`` is an observation and its aggregates; they are taken in the writing stage.
    """
    rows = silver.hint("rebalance", "tx_date") if many_days else silver
    _replace_partitions(rows.observe(*observe) if observe else rows, path, "tx_date")


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver without the quarantine below the same root; empty while no day is written."""
    root = path.rstrip("/")
    days = f"{root}/tx_date=*"
    if not path_exists(spark, days):
        return spark.createDataFrame([], SILVER_SCHEMA)
    files = spark.read.schema(SILVER_SCHEMA).option("basePath", root).parquet(days)
    return files.select(SILVER_SCHEMA.fieldNames())


def quarantine_path(silver_path: str) -> str:
    return f"{silver_path.rstrip('/')}/quarantine"


def write_quarantine(
    quarantine: DataFrame, silver_path: str, observe: tuple | None = None
) -> None:
    """Replace the ingest days that have rejects. Only rejected rows are shuffled."""
    rows = quarantine.hint("rebalance", "ingest_date")
    rows = rows.observe(*observe) if observe else rows
    _replace_partitions(rows, quarantine_path(silver_path), "ingest_date")


def read_quarantine(spark: SparkSession, silver_path: str) -> DataFrame:
    """All rejects; empty while none was ever written."""
    path = quarantine_path(silver_path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], QUARANTINE_SCHEMA)
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(path)


def write_version(table: DataFrame, path: str, number: int) -> None:
    """Write a small table as a whole, or not at all, as version ``number``.

    Each version goes to a folder of its own and writing it again replaces it. Readers take the newest
    finished one, so a write that fails leaves the table as it was. Versions older than the one before
    are dropped.
    """
    before = [v for v in _versions(table.sparkSession, path) if _number(v) < number]
    table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={number:012d}")
    for old in before[:-1]:
        drop_folder(table.sparkSession, old)


def _number(version: str) -> int:
    return int(version.rsplit("=", 1)[1])


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the finished versions, oldest first."""
    done = list_paths(spark, f"{path.rstrip('/')}/version=*/_SUCCESS")
    return sorted(marker.rsplit("/", 1)[0] for marker in done)


def newest_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest finished version."""
    return next(reversed(_versions(spark, path)), None)


def append_version(table: DataFrame, path: str) -> None:
    """``write_version`` with the next number."""
    newest = newest_version(table.sparkSession, path)
    write_version(table, path, _number(newest) + 1 if newest else 1)


def write_gold(gold: DataFrame, path: str, name: str) -> None:
    """Rebuild one Gold table as a whole, or not at all."""
    append_version(gold, f"{path.rstrip('/')}/{name}")


def read_gold(spark: SparkSession, path: str, name: str) -> DataFrame:
    newest = newest_version(spark, f"{path.rstrip('/')}/{name}")
    if newest is None:
        raise FileNotFoundError(f"no finished build of {name} below {path}")
    return spark.read.parquet(newest)


def files_by_day(spark: SparkSession, path: str, below: str = "") -> dict[date, str]:
    """For each event day below ``path`` a digest of its files' names.

    Spark names the files of each write anew, so the digest changes whenever a day is written. ``below``
    is a pattern of further folders inside a day's, with a slash at its end.
    """
    found: dict[date, list[str]] = {}
    for file in list_paths(spark, f"{path.rstrip('/')}/tx_date=*/{below}part-*"):
        day, name = file.rsplit("/tx_date=", 1)[1].split("/", 1)
        if day != NO_DAY:
            found.setdefault(date.fromisoformat(day), []).append(name)
    return {day: sha256(" ".join(sorted(names)).encode()).hexdigest() for day, names in found.items()}


def replace_days(rows: DataFrame, path: str, days: Iterable[date], order: Iterable[str] = ()) -> None:
    """Replace the given event days by those of ``rows``; a day without rows is gone after it.

    Each file is sorted by the columns of ``order``, so that filters on them skip its pages.
    """
    spark, root = rows.sparkSession, path.rstrip("/")
    before = files_by_day(spark, root)
    gathered = rows.hint("rebalance", "tx_date")
    gathered = gathered.sortWithinPartitions("tx_date", *order) if order else gathered
    _replace_partitions(gathered, root, "tx_date")
    after = files_by_day(spark, root)
    for day in days:
        if day in before and before[day] == after.get(day):
            drop_folder(spark, f"{root}/tx_date={day}")


def read_days(
    spark: SparkSession,
    path: str,
    schema: StructType,
    days: Iterable[date] | None = None,
    below: str = "",
) -> DataFrame:
    """A table kept by event day, of the given days only or of all; empty where there are none."""
    root, wanted = path.rstrip("/"), None if days is None else set(days)
    found = sorted(files_by_day(spark, root, below))
    known = [str(day) for day in found if wanted is None or day in wanted]
    if not known:
        return spark.createDataFrame([], schema)
    files = spark.read.schema(schema).option("basePath", root)
    return files.parquet(*[f"{root}/tx_date={day}" for day in known]).select(schema.fieldNames())


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Publish gauges: those named in ``metrics`` are replaced, all others stay.

    Each publish is a folder of its own, named by its time, so publishers at the same time lose nothing.
    Once there are many, the ones that are finished are merged.
    """
    _write_publish(metrics, path, f"{time.time_ns():020d}-{uuid.uuid4().hex}")
    if len(_publishes(metrics.sparkSession, path)) > MOST_PUBLISHES:
        compact_metrics(metrics.sparkSession, path)


def _write_publish(metrics: DataFrame, path: str, name: str) -> None:
    rows = metrics.hint("rebalance", "metric").write.partitionBy("metric")
    rows.parquet(f"{path.rstrip('/')}/publish={name}")


def _publishes(spark: SparkSession, path: str) -> list[str]:
    """Folders of the finished publishes, oldest first."""
    done = list_paths(spark, f"{path.rstrip('/')}/publish=*/_SUCCESS")
    return sorted(marker.rsplit("/", 1)[0] for marker in done)


def compact_metrics(spark: SparkSession, path: str) -> None:
    """Merge the finished publishes into one that takes the place of the newest of them.

    Publishes that come in meanwhile are newer and stay. Readers that have listed the old folders may
    have to read again.
    """
    old = _publishes(spark, path)
    if len(old) < 2:
        return
    # Sorts after the newest that it holds and before whatever is published later.
    _write_publish(_newest_gauges(spark, path, old), path, old[-1].rsplit("=", 1)[1] + "-m")
    for folder in old:
        drop_folder(spark, folder)


def _newest_gauges(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """Each gauge as its newest publish has it."""
    schema = StructType([*METRICS_SCHEMA.fields, StructField("publish", StringType())])
    files = spark.read.schema(schema).option("basePath", path.rstrip("/")).parquet(*folders)
    newest = F.max("publish").over(Window.partitionBy("metric"))
    rows = files.withColumn("newest", newest).filter("publish = newest")
    return rows.select(METRICS_SCHEMA.fieldNames())


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One value of each gauge and label set: that of the gauge's newest publish."""
    folders = _publishes(spark, path)
    if not folders:
        return spark.createDataFrame([], METRICS_SCHEMA)
    return _newest_gauges(spark, path, folders)


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A log table, empty before its first entry."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def write_feed_marker(spark: SparkSession, path: str) -> None:
    """Record that the feed has delivered its last day."""
    spark.createDataFrame([("done",)], "value string").write.mode("overwrite").text(path)


def feed_done(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)
