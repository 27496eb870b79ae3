"""Typed, deduplicated Silver rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions import (
    event_date,
    event_timestamp,
    int_prefix,
    is_suspicious,
    millis_to_timestamp,
    row_id,
    to_flag,
    to_money,
)
from ledgermill.operators.validation import valid_rows
from ledgermill.schema import SILVER_SCHEMA, STEP_EPOCH, as_day

# Which of several copies of a payment stays: the earliest, then the smallest flags and balances.
# Together with the row key these columns determine a Silver row, so the result is the same in
# every run.
SURVIVOR_ORDER = [
    "kafka_timestamp",
    "isFraud",
    "isFlaggedFraud",
    "oldbalanceOrg",
    "newbalanceOrig",
    "oldbalanceDest",
    "newbalanceDest",
]


def _typed(rows: DataFrame, step_epoch: str) -> DataFrame:
    """Silver columns next to those of ``rows`` that Silver does not have."""
    numbers = {
        "row_id": row_id(),
        "step": int_prefix("step"),
        "kafka_timestamp": millis_to_timestamp("kafka_timestamp"),
        "amount": to_money("amount"),
        "oldbalanceOrg": to_money("oldbalanceOrg"),
        "newbalanceOrig": to_money("newbalanceOrig"),
        "oldbalanceDest": to_money("oldbalanceDest"),
        "newbalanceDest": to_money("newbalanceDest"),
        "isFraud": to_flag("isFraud"),
        "isFlaggedFraud": to_flag("isFlaggedFraud"),
    }
    derived = {
        "tx_timestamp": event_timestamp(F.col("step"), step_epoch),
        "tx_date": event_date(F.col("step"), step_epoch),
        "is_suspicious": is_suspicious(F.col("isFraud"), F.col("isFlaggedFraud")),
    }
    return rows.withColumns(numbers).withColumns(derived)


def to_silver(labelled: DataFrame, step_epoch: str = STEP_EPOCH) -> DataFrame:
    """Typed projection of the valid records, copies still included."""
    return _typed(valid_rows(labelled), step_epoch).select(SILVER_SCHEMA.fieldNames())


def event_days(rows: DataFrame, start: str | date, end: str | date | None = None) -> DataFrame:
    """Rows of the days ``start`` to ``end`` (inclusive), of one day without ``end``."""
    first, last = as_day(start), as_day(end or start)
    return rows.filter(F.col("tx_date").between(F.lit(first), F.lit(last)))


def dedup(silver: DataFrame) -> DataFrame:
    """One row per ``row_id``.

    Spark turns the ``= 1`` filter into a group limit on both sides of the shuffle: each task keeps
    one row per key before anything is sent, so a payment redelivered without end costs one row per
    task and no reducer receives all of its copies.
    """
    order = [F.asc_nulls_last(name) for name in SURVIVOR_ORDER]
    position = F.row_number().over(Window.partitionBy("row_id").orderBy(*order))
    return silver.withColumn("copy", position).filter("copy = 1").drop("copy")


def run_summary(labelled: DataFrame, step_epoch: str = STEP_EPOCH) -> DataFrame:
    """Counts of a full run as one row: read, valid, rejected, removed copies, kept, suspicious.

    One pass and one shuffle: rejected rows share the NULL key, every other key brings its number
    of copies and the flags of its survivor. Both collapse before the shuffle.
    """
    nulls_last = [part for name in SURVIVOR_ORDER for part in (F.col(name).isNull(), F.col(name))]
    ranked = F.struct(
        *[part.alias(f"rank_{i}") for i, part in enumerate(nulls_last)],
        F.col("is_suspicious").alias("suspicious"),
    )
    key = F.when(F.col("reject_reason").isNull(), F.col("row_id"))
    payments = (
        _typed(labelled, step_epoch)
        .groupBy(key.alias("payment"))
        .agg(F.count(F.lit(1)).alias("copies"), F.min(ranked).alias("survivor"))
    )
    is_payment = F.col("payment").isNotNull()

    def total(condition) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("copies"))), F.lit(0))

    return payments.agg(
        total(F.lit(True)).alias("bronze_rows"),
        total(is_payment).alias("valid_rows"),
        total(~is_payment).alias("quarantine_rows"),
        (total(is_payment) - F.count("payment")).alias("dedup_removed"),
        F.count("payment").alias("silver_rows"),
        F.count_if(is_payment & F.col("survivor.suspicious")).alias("suspicious_rows"),
    )
