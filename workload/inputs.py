"""Payment records derived from the ``events`` table, one per event, some of them broken.

The rules are fixed in FIXTURES.md; the same ones are written as SQL in ``workload/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.schema import PAYLOAD_FIELDS

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
)

# Expressions over an event, with k its id, amt its value and hr its hour from 1.
RECORD_RULES = {
    "step": """CASE WHEN k % 211 = 7 THEN '0' WHEN k % 223 = 11 THEN '744'
               WHEN k % 227 = 13 THEN 'x1' ELSE CAST(hr AS STRING) END""",
    "type": """CASE WHEN k % 229 = 17 THEN 'WIRE' WHEN event_type = 'click' THEN 'PAYMENT'
               WHEN event_type = 'view' THEN 'CASH_IN' WHEN event_type = 'signup' THEN 'DEBIT'
               WHEN event_type = 'purchase' THEN 'TRANSFER'
               WHEN event_type = 'error' THEN 'CASH_OUT' END""",
    "amount": """CASE WHEN k % 233 = 19 THEN NULL WHEN k % 239 = 23 THEN '0.00'
                 WHEN k % 241 = 29 THEN 'abc' WHEN k % 251 = 31 THEN '-' || CAST(amt AS STRING)
                 ELSE CAST(amt AS STRING) END""",
    "nameOrig": "CASE WHEN k % 257 = 37 THEN NULL ELSE 'C' || CAST(user_id AS STRING) END",
    "oldbalanceOrg": """CASE WHEN k % 263 = 41 THEN '-1.00'
                        ELSE CAST(CAST(amt * 10 AS DECIMAL(18,2)) AS STRING) END""",
    "newbalanceOrig": """CASE WHEN k % 269 = 43 THEN '-1.00'
                         ELSE CAST(CAST(amt * 9 AS DECIMAL(18,2)) AS STRING) END""",
    "nameDest": "'M' || CAST((k * 7919) % 97 AS STRING)",
    "oldbalanceDest": """CASE WHEN k % 271 = 47 THEN '-1.00'
                         ELSE CAST(k % 1000 AS STRING) || '.00' END""",
    "newbalanceDest": "CAST(CAST(k % 1000 + amt AS DECIMAL(18,2)) AS STRING)",
    "isFraud": """CASE WHEN k % 277 = 53 THEN '2' WHEN k % 281 = 59 THEN NULL
                  WHEN k % 20 = 3 AND event_type IN ('purchase', 'error') THEN '1'
                  ELSE '0' END""",
    "isFlaggedFraud": """CASE WHEN k % 293 = 67 THEN 'Y'
                         WHEN k % 100 = 3 AND event_type IN ('purchase', 'error') THEN '1'
                         WHEN k % 283 = 61 THEN '1' ELSE '0' END""",
}
FIRST_DELIVERY_RULE = """CASE WHEN k % 307 = 71 OR k % 422 = 7 THEN NULL
                         ELSE 1767225600000 + k * 1000 END"""
REDELIVERED = "k % 40 = 5"
REDELIVERY_DELAY_MS = 60000


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir).select(
        F.col("event_id").alias("k"),
        F.col("value").cast("decimal(18,2)").alias("amt"),
        F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) + 1").alias("hr"),
        "user_id",
        "event_type",
    )


def _payload() -> list[Column]:
    return [F.expr(RECORD_RULES[name]).alias(name) for name in PAYLOAD_FIELDS]


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload text columns, one record per event."""
    return _events(spark, sf_dir).select(_payload())


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze records; every 40th one was delivered twice, a minute apart.

    Both deliveries are unfolded from one record, so each rule is worked out once per event and
    filters on payload fields see plain columns.
    """
    record = F.struct(*_payload(), F.expr(FIRST_DELIVERY_RULE).alias("kafka_timestamp"))
    rows = _events(spark, sf_dir).select("k", record.alias("record"))
    again = F.col("record").withField(
        "kafka_timestamp", F.col("record.kafka_timestamp") + REDELIVERY_DELAY_MS
    )
    deliveries = F.when(F.expr(REDELIVERED), F.array("record", again)).otherwise(
        F.array("record")
    )
    return rows.select(F.inline(deliveries))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as ``key, value, timestamp`` messages of a Kafka source."""
    record = F.to_json(F.struct(*PAYLOAD_FIELDS), {"ignoreNullFields": "false"})
    return bronze(spark, sf_dir).select(
        F.col("nameOrig").alias("key"),
        record.alias("value"),
        F.timestamp_millis("kafka_timestamp").alias("timestamp"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log in which each event is a run of its day that ended, failed or goes on."""
    state = """CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed'
               ELSE 'running' END"""
    return _table(spark, sf_dir).select(
        F.to_date("ts").alias("logical_date"), F.expr(state).alias("state")
    )


def task_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task log with one task per event type and the event's value as seconds."""
    state = "CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END"
    return _table(spark, sf_dir).select(
        F.col("event_type").alias("task_id"),
        F.col("value").alias("duration_s"),
        F.expr(state).alias("state"),
    )
