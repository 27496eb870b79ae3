"""Bronze's own count of each event day's payments, kept so that no run reads an ingest day again.

The digests of the payments of an event day are kept by the ingest day on which they came in. A run
replaces those of the ingest days it has read, and counts again only the event days it found there. A
payment that was delivered on several ingest days is counted once, whichever run read which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgermill.operators import reconcile
from ledgermill.sources import tables

KEYS_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("tx_date", T.DateType()),
        T.StructField("ingest", T.DateType()),
    ]
)
COUNTS_SCHEMA = T.StructType(
    [T.StructField("tx_date", T.DateType()), T.StructField("bronze_rows", T.LongType())]
)


def update_bronze_days(keys: DataFrame, path: str) -> None:
    """Take in ``keys``, all that were found on the ingest days they name.

    Counts are written after keys; should that fail, the days are found to lack a count and done again.
    """
    spark, root = keys.sparkSession, path.rstrip("/")
    (
        keys.hint("rebalance", "tx_date", "ingest")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("tx_date", "ingest")
        .parquet(f"{root}/keys")
    )
    now = tables.files_by_day(spark, f"{root}/keys", "ingest=*/")
    newest = tables.newest_version(spark, f"{root}/done")
    known = {r.tx_date: r.files for r in spark.read.parquet(newest).collect()} if newest else {}
    changed = sorted(day for day in now if now[day] != known.get(day))
    if not changed:
        return
    kept = tables.read_days(spark, f"{root}/keys", KEYS_SCHEMA, changed, "ingest=*/")
    tables.replace_days(reconcile.bronze_rows_of(kept), f"{root}/counts", changed)
    done = spark.createDataFrame(list(now.items()), "tx_date DATE, files STRING")
    tables.append_version(done.coalesce(1), f"{root}/done")


def read_bronze_days(spark: SparkSession, path: str) -> DataFrame:
    """``tx_date, bronze_rows`` of all event days seen so far."""
    return tables.read_days(spark, f"{path.rstrip('/')}/counts", COUNTS_SCHEMA)
