"""Labelling Bronze records and splitting them into valid and rejected ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import ingest_date, millis_to_timestamp, payload_json, reject_reason

IS_VALID = "reject_reason IS NULL"
IS_REJECTED = "reject_reason IS NOT NULL"


class CountMismatch(RuntimeError):
    """Records were lost or doubled between two layers."""


def label(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Bronze plus ``reject_reason``, NULL for valid records."""
    return bronze.withColumn("reject_reason", reject_reason(strict))


def valid_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(IS_VALID).drop("reject_reason")


def rejected_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(IS_REJECTED)


def to_quarantine(labelled: DataFrame) -> DataFrame:
    """Rejected records as JSON text with their reason and ingest day."""
    return rejected_rows(labelled).select(
        payload_json(labelled.columns).alias("value"),
        millis_to_timestamp("kafka_timestamp").alias("kafka_timestamp"),
        "reject_reason",
        ingest_date("kafka_timestamp").alias("ingest_date"),
    )


def split_counts() -> list[Column]:
    """Aggregates over labelled records: all, valid and rejected ones."""
    return [
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(F.expr(IS_VALID)).alias("valid_rows"),
        F.count_if(F.expr(IS_REJECTED)).alias("quarantine_rows"),
    ]


def conservation(labelled: DataFrame) -> DataFrame:
    """One row telling whether every Bronze record is either valid or rejected."""
    return labelled.agg(*split_counts()).withColumn(
        "conserved",
        F.col("bronze_rows") == F.col("valid_rows") + F.col("quarantine_rows"),
    )


def check_conservation(bronze: int, valid: int, quarantine: int) -> None:
    if bronze != valid + quarantine:
        raise CountMismatch(
            f"bronze={bronze} differs from valid={valid} + quarantine={quarantine}"
        )
