"""Key figures of the existing fraud rule, activity rollups and top receivers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP_ACCOUNTS = 10


def confusion_counts() -> list[Column]:
    """Aggregates over Silver that set the true label against the rule's flag."""
    fraud, flagged = F.col("isFraud"), F.col("isFlaggedFraud")
    return [
        F.count_if(fraud == 1).alias("actual"),
        F.count_if(flagged == 1).alias("flagged"),
        F.count_if((fraud == 1) & (flagged == 1)).alias("true_positive"),
        F.count_if((fraud == 0) & (flagged == 1)).alias("false_positive"),
        F.count_if("is_suspicious").alias("false_negative"),
    ]


def confusion(silver: DataFrame) -> DataFrame:
    return silver.agg(*confusion_counts())


def share(part: str, whole: str) -> Column:
    """``part / whole``, 0.0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def rule_quality(counts: DataFrame) -> DataFrame:
    return counts.select(
        share("true_positive", "flagged").alias("rule_precision"),
        share("true_positive", "actual").alias("rule_recall"),
    )


def by_hour(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("tx_hour").agg(
        F.sum("tx_count").alias("tx_count"), F.sum("fraud_count").alias("fraud_count")
    )


def by_type(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("type").agg(
        F.sum("tx_count").alias("tx_count"), F.sum("fraud_count").alias("fraud_count")
    )


def top_receivers(silver: DataFrame, n: int = TOP_ACCOUNTS) -> DataFrame:
    """Accounts that received fraud most often, equal counts in order of name.

    Only fraud rows leave the scan, and the limit is a distributed top-k, not a full sort.
    """
    return (
        silver.filter("isFraud = 1")
        .groupBy("nameDest")
        .agg(F.count(F.lit(1)).alias("recv_count"))
        .orderBy(F.desc("recv_count"), "nameDest")
        .limit(n)
    )


def undetected_total(undetected: DataFrame) -> DataFrame:
    return undetected.agg(F.count(F.lit(1)).alias("undetected_total"))
