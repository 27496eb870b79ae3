"""What each event day adds to the Gold tables, in a form that days can be added up or replaced."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.operators import gold, kpis

# Receivers of each day that are kept apart as its head.
HEAD = 100
# Receivers that are looked up by name in what is left of the days; more are joined.
MOST_NAMES = 200
# Fixed value: names in one list that the Parquet reader compares one by one.
NAMES_IN_LIST = 10

ACCOUNT_SUMS = ["total_tx_count", "total_amount", "fraud_tx_count", "suspicious_tx_count", "fraud_amount"]


def hours(silver: DataFrame) -> DataFrame:
    """``hourly_summary`` with the event day; an hour lies on one day."""
    return gold.hourly_summary(silver, "tx_date")


def accounts(silver: DataFrame) -> DataFrame:
    """Sums of each sending account on each day. Map-side sums leave one row per account and task."""
    return silver.groupBy("tx_date", F.col("nameOrig").alias("account_id")).agg(*gold.account_sums())


def receivers(silver: DataFrame) -> DataFrame:
    """Fraud payments that each account received on each day."""
    return (
        silver.filter("isFraud = 1")
        .groupBy("tx_date", "nameDest")
        .agg(F.count(F.lit(1)).alias("recv_count"))
    )


def receiver_heads(silver: DataFrame) -> DataFrame:
    """Of each day the ``HEAD`` receivers with most fraud, equal counts in order of name."""
    order = Window.partitionBy("tx_date").orderBy(F.desc("recv_count"), "nameDest")
    ranked = receivers(silver).withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= HEAD).drop("place")


def counts(silver: DataFrame) -> DataFrame:
    """One row per day: Silver rows, the rule's confusion counts."""
    return (
        silver.groupBy("tx_date")
        .agg(F.count(F.lit(1)).alias("silver_rows"), *kpis.confusion_counts())
        .withColumnsRenamed({"actual": "fraud_rows", "false_negative": "suspicious_rows"})
    )


def account_risk(days: DataFrame) -> DataFrame:
    """``account_risk`` from the daily sums of accounts."""
    sums = [F.sum(name).cast(days.schema[name].dataType).alias(name) for name in ACCOUNT_SUMS]
    totals = days.groupBy("account_id").agg(*sums, F.max("last_tx_at").alias("last_tx_at"))
    return gold.with_fraud_rate(totals.filter("fraud_tx_count > 0"))


def involved(days: DataFrame) -> DataFrame:
    """``account_id`` of the accounts with fraud."""
    return days.filter("fraud_tx_count > 0").select("account_id").distinct()


def top_receivers(days: DataFrame, n: int = kpis.TOP_ACCOUNTS) -> DataFrame:
    """``kpis.top_receivers`` from all daily counts."""
    return _first(_totals(days), n)


def _totals(days: DataFrame) -> DataFrame:
    return days.groupBy("nameDest").agg(F.sum("recv_count").alias("recv_count"))


def _first(totals: DataFrame, n: int) -> DataFrame:
    return totals.orderBy(F.desc("recv_count"), "nameDest").limit(n)


def nth_total(totals: DataFrame, n: int) -> int:
    """The n-th largest total; zero where there are fewer."""
    row = _first(totals, n).agg(F.count(F.lit(1)).alias("found"), F.min("recv_count").alias("least")).first()
    return row.least if row.found == n else 0


def top_by_threshold(days: DataFrame, n_days: int, n: int, sure: int) -> DataFrame:
    """``top_receivers`` from a share of the daily counts, given that n receivers have ``sure`` in total.

    A receiver below ``sure / n_days`` on every day has less than ``sure`` and is none of them, so only
    the counts from there up are added first. What a receiver may have on days where it was not seen is
    then bounded, and those that may still reach the n-th sum are looked up in the rest. ``days`` may be
    any number of rows; where it is sorted by count and name both filters skip most pages.
    """
    floor = max(1, -(-sure // max(1, n_days)))
    if floor == 1:
        return top_receivers(days, n)
    high = days.filter(F.col("recv_count") >= floor)
    seen = high.groupBy("nameDest").agg(
        F.sum("recv_count").alias("recv_count"), F.count(F.lit(1)).alias("n_seen")
    )
    bar = max(sure, nth_total(seen, n))
    most = F.col("recv_count") + (n_days - F.col("n_seen")) * (floor - 1)
    open_ones = seen.filter(most >= bar).select("nameDest", "recv_count")
    low = days.filter(F.col("recv_count") < floor).select("nameDest", "recv_count")
    names = [row.nameDest for row in open_ones.select("nameDest").limit(MOST_NAMES + 1).collect()]
    if len(names) > MOST_NAMES:
        rest = low.join(open_ones.select("nameDest"), "nameDest", "left_semi")
    else:
        rest = low.filter(_named(names))
    return _first(_totals(open_ones.unionByName(rest)), n)


def _named(names: list[str]) -> Column:
    """``nameDest`` is one of ``names``, in lists short enough to be pushed to the scan."""
    lists = [names[at : at + NAMES_IN_LIST] for at in range(0, len(names), NAMES_IN_LIST)]
    return reduce(or_, [F.col("nameDest").isin(part) for part in lists], F.lit(False))


# Tables kept by event day, and what fills them from Silver.
DAY_TABLES = {
    "undetected_fraud": gold.undetected_fraud,
    "hourly_summary": hours,
    "account_days": accounts,
    "receiver_days": receivers,
    "receiver_heads": receiver_heads,
    "day_counts": counts,
}

# Order of rows in the files of a table kept by day, where its readers filter by these columns.
DAY_ORDER = {"receiver_days": ("recv_count", "nameDest")}
