"""What has arrived of each event day, kept by a stream.

The completeness gate needs two facts of a feed: how many records each event day has, and which is the
last day that has any. A streaming aggregation holds one small count per event day and publishes them
after each batch, so the gate reads a table of at most a month of rows instead of all Bronze.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.operators import gate
from ledgermill.schema import STEP_EPOCH
from ledgermill.sources import tables
from ledgermill.streaming.ingest import ROLL_SECONDS, to_bronze

ARRIVALS_SCHEMA = "tx_date DATE, day_rows BIGINT"


def arrivals_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    step_epoch: str = STEP_EPOCH,
    validate_step: bool = True,
    roll_seconds: int = ROLL_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the query that counts messages by event day into versions of a table at ``path``.

    The counts are the query's state, in its checkpoint; a version bears the number of its batch, so a
    batch that is repeated after a failure writes the same version again and counts nothing twice.
    """
    trigger = (
        {"availableNow": True} if available_now else {"processingTime": f"{roll_seconds} seconds"}
    )
    days = gate.arrived_by_day(to_bronze(messages), step_epoch, validate_step)

    def publish(counts: DataFrame, number: int) -> None:
        tables.write_version(counts.coalesce(1), path, number)

    return (
        days.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """``tx_date, day_rows`` after the last whole batch; empty before the first."""
    newest = tables.newest_version(spark, path)
    if newest is None:
        return spark.createDataFrame([], ARRIVALS_SCHEMA)
    return spark.read.schema(ARRIVALS_SCHEMA).parquet(newest)
