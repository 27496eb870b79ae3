"""Serving queries over the published metrics table, as a dashboard asks them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.kpis import TOP_ACCOUNTS
from ledgermill.plans.metrics import ACCOUNT_LABEL, DAY_LABEL, LAST_SUCCESS_GAUGE


def gauge(metrics: DataFrame, name: str) -> DataFrame:
    """All label sets of one gauge; on a stored table only its own partition is read."""
    return metrics.filter(F.col("metric") == name)


def total_rows(metrics: DataFrame) -> DataFrame:
    return gauge(metrics, "fraud_by_date_rows").agg(F.sum("value").alias("total_rows"))


def last_success_millis(metrics: DataFrame) -> DataFrame:
    last = gauge(metrics, LAST_SUCCESS_GAUGE)
    return last.select((F.col("value") * 1000).alias("last_success_ms"))


def top_receivers(metrics: DataFrame, n: int = TOP_ACCOUNTS) -> DataFrame:
    account = F.col("labels")[ACCOUNT_LABEL].alias("account")
    receivers = gauge(metrics, "fraud_mule_recv_count").select(account, "value")
    return receivers.orderBy(F.desc("value"), "account").limit(n)


def runs_by_day(metrics: DataFrame) -> DataFrame:
    """Successful and failed runs side by side; a day that only one gauge knows shows 0."""

    def value_of(name: str):
        return F.coalesce(F.max(F.when(F.col("metric") == name, F.col("value"))), F.lit(0.0))

    success, failed = "fraud_dagrun_success", "fraud_dagrun_failed"
    return (
        metrics.filter(F.col("metric").isin(success, failed))
        .groupBy(F.col("labels")[DAY_LABEL].alias(DAY_LABEL))
        .agg(value_of(success).alias("success_runs"), value_of(failed).alias("failed_runs"))
    )
