"""Hand-made Bronze records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.schema import BRONZE_SCHEMA

VALID = {
    "step": "1",
    "type": "PAYMENT",
    "amount": "10.00",
    "nameOrig": "C1",
    "oldbalanceOrg": "100.00",
    "newbalanceOrig": "90.00",
    "nameDest": "M1",
    "oldbalanceDest": "0.00",
    "newbalanceDest": "10.00",
    "isFraud": "0",
    "isFlaggedFraud": "0",
    "kafka_timestamp": 1767225600000,
}


def record(**changes) -> dict:
    return VALID | changes


def bronze(spark: SparkSession, *records: dict) -> DataFrame:
    rows = [tuple(r[name] for name in BRONZE_SCHEMA.fieldNames()) for r in records]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)
