"""Do Bronze, Silver and Gold hold the same payments?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import event_date, ingest_date, row_id, row_key, to_number
from ledgermill.operators.validation import CountMismatch
from ledgermill.schema import (
    FIRST_STEP,
    FLAG_VALUES,
    LAST_STEP,
    PAYMENT_TYPES,
    STEP_EPOCH,
)


def silver_by_date(silver: DataFrame) -> DataFrame:
    return silver.groupBy("tx_date").agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if(F.col("isFraud") == 1).alias("fraud_rows"),
        F.count_if("is_suspicious").alias("suspicious_rows"),
    )


def gold_by_date(undetected: DataFrame) -> DataFrame:
    return undetected.groupBy("tx_date").agg(F.count(F.lit(1)).alias("gold_rows"))


def _passes_mirror() -> Column:
    """Validity spelled out once more, apart from the labelling rules, as a cross-check of them.

    It is the stricter reading: flags have to be there, a step has to be a plain integer and NaN
    is not a positive amount.
    """
    amount = to_number("amount")
    step = F.col("step").try_cast("bigint")
    # Comparisons fail on missing values by themselves; only the names have none.
    terms = [
        F.col("nameOrig").isNotNull() & F.col("nameDest").isNotNull(),
        amount > 0,
        ~F.isnan(amount),
        step.between(FIRST_STEP, LAST_STEP),
        F.col("type").isin(PAYMENT_TYPES),
        F.col("isFraud").isin(FLAG_VALUES),
        F.col("isFlaggedFraud").isin(FLAG_VALUES),
        ~F.coalesce(to_number("oldbalanceOrg") < 0, F.lit(False)),
        ~F.coalesce(to_number("newbalanceOrig") < 0, F.lit(False)),
    ]
    condition = terms[0]
    for term in terms[1:]:
        condition = condition & term
    return condition


def mirror_day(step_epoch: str = STEP_EPOCH) -> Column:
    """Event day of a Bronze record that passes the independent check, NULL for all others."""
    return F.when(_passes_mirror(), event_date(F.col("step").try_cast("int"), step_epoch))


def bronze_keys(records: DataFrame, day: str) -> DataFrame:
    """``tx_date, ingest, key``: the distinct payments of each event day that came in on each ingest day.

    ``day`` names the column of ``mirror_day``. The key is a digest of 32 bytes.
    """
    return (
        records.filter(F.col(day).isNotNull())
        .select(
            F.col(day).alias("tx_date"),
            ingest_date("kafka_timestamp").alias("ingest"),
            F.unhex(row_id()).alias("key"),
        )
        .distinct()
    )


def bronze_rows_of(keys: DataFrame) -> DataFrame:
    """``tx_date, bronze_rows`` from those keys; one delivered on several ingest days counts once."""
    return keys.groupBy("tx_date").agg(F.count_distinct("key").alias("bronze_rows"))


def bronze_valid_by_date(bronze: DataFrame, step_epoch: str = STEP_EPOCH) -> DataFrame:
    """Distinct valid payments of each event day, counted from Bronze alone.

    Counting the distinct key text equals counting its hashes and saves computing and shuffling
    them. Copies collapse before the shuffle.
    """
    return (
        bronze.filter(_passes_mirror())
        .select(
            event_date(F.col("step").try_cast("int"), step_epoch).alias("tx_date"),
            row_key().alias("row_key"),
        )
        .groupBy("tx_date")
        .agg(F.count_distinct("row_key").alias("bronze_rows"))
    )


def by_date(
    bronze_days: DataFrame,
    silver_days: DataFrame,
    gold_days: DataFrame,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per event day the counts of all layers and their differences, a missing layer being 0.

    The inputs have one row per day, at most 31. ``carry`` names further counts to take along.
    """
    counts = ["bronze_rows", "silver_rows", "fraud_rows", "suspicious_rows", "gold_rows", *carry]
    joined = silver_days.join(bronze_days, "tx_date", "full").join(gold_days, "tx_date", "full")
    return joined.select(
        "tx_date", *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in counts]
    ).withColumns(
        {
            "bs_diff": F.col("bronze_rows") - F.col("silver_rows"),
            "sg_diff": F.col("suspicious_rows") - F.col("gold_rows"),
        }
    )


def worst(days: DataFrame) -> DataFrame:
    """Largest absolute difference between two neighbouring layers on any day."""
    return days.agg(
        F.coalesce(F.max(F.abs("bs_diff")), F.lit(0)).alias("bs_diff_max"),
        F.coalesce(F.max(F.abs("sg_diff")), F.lit(0)).alias("sg_diff_max"),
    )


def total(silver: DataFrame, undetected: DataFrame) -> DataFrame:
    """One row comparing suspicious Silver rows with Gold rows."""
    layers = silver.agg(
        F.lit(0).cast("bigint").alias("gold_rows"),
        F.count_if("is_suspicious").alias("suspicious_rows"),
    ).unionByName(
        undetected.agg(
            F.count(F.lit(1)).alias("gold_rows"),
            F.lit(0).cast("bigint").alias("suspicious_rows"),
        )
    )
    return layers.agg(
        F.sum("gold_rows").alias("gold_rows"), F.sum("suspicious_rows").alias("suspicious_rows")
    ).withColumn("matches", F.col("gold_rows") == F.col("suspicious_rows"))


def check_total(gold_rows: int, suspicious_rows: int) -> None:
    if gold_rows != suspicious_rows:
        raise CountMismatch(
            f"undetected_fraud={gold_rows} differs from suspicious silver={suspicious_rows}"
        )


def total_rows(silver_days: DataFrame) -> DataFrame:
    """Headline: all Silver rows, summed over the days."""
    return silver_days.agg(F.sum("silver_rows").alias("total_rows"))
