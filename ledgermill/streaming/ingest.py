"""Message stream to Bronze files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgermill.functions import ingest_date
from ledgermill.schema import CORRUPT_FIELD, PAYLOAD_FIELDS, PAYLOAD_SCHEMA, RAW_VALUE_FIELD
from ledgermill.sources.bronze import write_batch

MESSAGE_SCHEMA = T.StructType(
    PAYLOAD_SCHEMA.fields + [T.StructField(CORRUPT_FIELD, T.StringType())]
)

# A Bronze file is rolled after this many records or seconds.
ROLL_RECORDS = 1000
ROLL_SECONDS = 60


def to_bronze(messages: DataFrame) -> DataFrame:
    """Payload fields of each message, its record time in milliseconds and its ingest day.

    ``messages`` has the shape of a Kafka source: ``key, value, timestamp``. A value that is no
    JSON object, or has fields beyond the payload's, keeps its text in ``raw_value``, so the raw
    layer loses nothing and the quarantine can show the record as it came in.
    """
    others = F.array_except(
        F.json_object_keys(F.col("value").cast("string")),
        F.array(*[F.lit(name) for name in PAYLOAD_FIELDS]),
    )
    text = F.when(F.size(others) > 0, F.col("value").cast("string"))
    parsed = F.from_json(
        F.col("value").cast("string"),
        MESSAGE_SCHEMA,
        {"columnNameOfCorruptRecord": CORRUPT_FIELD},
    )
    return messages.select(
        parsed.alias("record"),
        text.alias("text"),
        F.unix_millis("timestamp").alias("kafka_timestamp"),
    ).select(
        *[F.col(f"record.{name}") for name in PAYLOAD_FIELDS],
        F.coalesce(f"record.{CORRUPT_FIELD}", "text").alias(RAW_VALUE_FIELD),
        "kafka_timestamp",
        ingest_date("kafka_timestamp").alias("date"),
    )


def ingest_stream(
    messages: DataFrame,
    bronze_path: str,
    checkpoint: str,
    roll_records: int = ROLL_RECORDS,
    roll_seconds: int = ROLL_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the query that lands messages as JSON lines below ``date=`` folders.

    The checkpoint records which messages make up each batch, and a batch lands in folders that bear its
    number. One that is repeated after a failure replaces what it had landed, so a restart neither
    repeats nor skips a message, and there is no list of files that grows with the feed.
    ``available_now`` takes in what is there and stops. A large feed should raise ``roll_records``:
    a thousand records are well under a megabyte.
    """
    trigger = (
        {"availableNow": True} if available_now else {"processingTime": f"{roll_seconds} seconds"}
    )

    def land(batch: DataFrame, number: int) -> None:
        write_batch(to_bronze(batch), bronze_path, number, roll_records)

    return (
        messages.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
