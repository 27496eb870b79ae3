"""Record layouts and the fixed values that every layer agrees on."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import types as T

# --- Fixed values: must equal the published data contract --------------------------------------

# Payload fields of a raw payment record, in file order. All of them travel as text.
PAYLOAD_FIELDS = [
    "step",
    "type",
    "amount",
    "nameOrig",
    "oldbalanceOrg",
    "newbalanceOrig",
    "nameDest",
    "oldbalanceDest",
    "newbalanceDest",
    "isFraud",
    "isFlaggedFraud",
]

# Fields without which a record cannot be interpreted at all.
REQUIRED_FIELDS = ["step", "amount", "nameOrig", "type", "nameDest"]

# Fields whose raw text makes up the row key, in hashing order, and their separator.
ROW_KEY_FIELDS = ["nameOrig", "step", "type", "amount", "nameDest"]
ROW_KEY_SEPARATOR = "|"

PAYMENT_TYPES = ["PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT"]

# The only payment types in which fraud is expected.
FRAUD_TYPES = ["CASH_OUT", "TRANSFER"]

FLAG_VALUES = ["0", "1"]

# Steps are hours counted from 1; the last accepted one closes a 31-day month.
FIRST_STEP = 1
LAST_STEP = 743

# UTC instant at which step 1 begins.
STEP_EPOCH = "2016-01-01 00:00:00"

# --- Layouts ------------------------------------------------------------------------------------

MONEY = T.DecimalType(18, 2)

# Text of a Bronze line that is not valid JSON (filled by the reader).
CORRUPT_FIELD = "_corrupt_record"
# Text of a message that was not valid JSON when it was landed (filled by the ingest stream).
RAW_VALUE_FIELD = "raw_value"

PAYLOAD_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in PAYLOAD_FIELDS])

BRONZE_SCHEMA = T.StructType(
    PAYLOAD_SCHEMA.fields + [T.StructField("kafka_timestamp", T.LongType())]
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.StringType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("tx_timestamp", T.TimestampType()),
        T.StructField("tx_date", T.DateType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", MONEY),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", MONEY),
        T.StructField("newbalanceOrig", MONEY),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", MONEY),
        T.StructField("newbalanceDest", MONEY),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
        T.StructField("is_suspicious", T.BooleanType()),
    ]
)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("logical_date", T.DateType()),
        T.StructField("state", T.StringType()),
    ]
)

TASK_LOG_SCHEMA = T.StructType(
    [
        T.StructField("task_id", T.StringType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("state", T.StringType()),
    ]
)


def epoch_seconds(step_epoch: str = STEP_EPOCH) -> int:
    """Unix seconds of a ``YYYY-MM-DD HH:MM:SS`` UTC instant."""
    moment = datetime.fromisoformat(step_epoch).replace(tzinfo=timezone.utc)
    return int(moment.timestamp())


def as_day(day: str | date) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)
