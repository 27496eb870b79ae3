"""Gold tables over Silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import event_hour
from ledgermill.schema import SILVER_SCHEMA

UNDETECTED_COLUMNS = [
    name for name in SILVER_SCHEMA.fieldNames() if name not in ("step", "kafka_timestamp")
]

# Tasks that share the payments of one account where they have to be shuffled.
ACCOUNT_SALTS = 16


def _fraud_amount():
    return F.sum(F.when(F.col("isFraud") == 1, F.col("amount")).otherwise(0))


def undetected_fraud(silver: DataFrame) -> DataFrame:
    """Fraud that the existing rule missed, with what the payment did to both balances."""
    return silver.filter("is_suspicious").select(
        *UNDETECTED_COLUMNS,
        (F.col("oldbalanceOrg") - F.col("newbalanceOrig")).alias("orig_balance_drop"),
        (F.col("newbalanceDest") - F.col("oldbalanceDest")).alias("dest_balance_gain"),
    )


def hourly_summary(silver: DataFrame, *carry: str) -> DataFrame:
    """Activity and fraud by hour and payment type, and by the columns of ``carry``."""
    return silver.groupBy(*carry, event_hour("tx_timestamp").alias("tx_hour"), "type").agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum("amount").alias("total_amount"),
        F.count_if(F.col("isFraud") == 1).alias("fraud_count"),
        F.count_if("is_suspicious").alias("suspicious_count"),
        _fraud_amount().alias("fraud_amount"),
    )


def account_sums() -> list[Column]:
    """Aggregates over the payments of an account."""
    return [
        F.count(F.lit(1)).alias("total_tx_count"),
        F.sum("amount").alias("total_amount"),
        F.count_if(F.col("isFraud") == 1).alias("fraud_tx_count"),
        F.count_if("is_suspicious").alias("suspicious_tx_count"),
        _fraud_amount().alias("fraud_amount"),
        F.max("tx_timestamp").alias("last_tx_at"),
    ]


def with_fraud_rate(accounts: DataFrame) -> DataFrame:
    """The columns of ``account_risk`` from an account's sums."""
    fraud_share = F.col("fraud_tx_count") / F.col("total_tx_count") * 100
    return accounts.withColumn("fraud_rate_pct", F.round(fraud_share, 2)).select(
        "account_id",
        "total_tx_count",
        "total_amount",
        "fraud_tx_count",
        "suspicious_tx_count",
        "fraud_amount",
        "fraud_rate_pct",
        "last_tx_at",
    )


def account_risk(silver: DataFrame) -> DataFrame:
    """Totals of each sending account that took part in a fraud.

    Nearly every account sends once, so summing all of them first would shuffle the whole table for
    the few that stay. Their names are found first, from the fraud rows only, and the payments are
    reduced to these accounts. Where that join has to shuffle, it does so on the name and a salt, so a
    busy account is spread over several tasks. Map-side partial sums then leave at most one row per
    account and task.
    """
    involved = (
        silver.filter(F.col("isFraud") == 1)
        .select(F.col("nameOrig").alias("involved"))
        .distinct()
        .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(ACCOUNT_SALTS - 1))))
    )
    salt = F.pmod(F.xxhash64("tx_timestamp", "amount"), F.lit(ACCOUNT_SALTS)).cast("int")
    return with_fraud_rate(
        silver.withColumn("salt", salt)
        .join(
            involved,
            F.col("nameOrig").eqNullSafe(F.col("involved")) & (F.col("salt") == F.col("s")),
            "left_semi",
        )
        .groupBy(F.col("nameOrig").alias("account_id"))
        .agg(*account_sums())
    )


def sorted_hourly(hourly: DataFrame) -> DataFrame:
    return hourly.orderBy("tx_hour", "type")


def sorted_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.orderBy(F.desc("fraud_amount"), "account_id")


# Every Gold table by name, in build order.
GOLD_TABLES = {
    "undetected_fraud": undetected_fraud,
    "hourly_summary": hourly_summary,
    "account_risk": account_risk,
}
