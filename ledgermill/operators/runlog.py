"""Aggregates over the run log and the task log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUCCESS = "success"
FAILED = "failed"
RUNNING = "running"


def runs_by_day(run_log: DataFrame) -> DataFrame:
    """Successful and failed runs of every logical day that has any run at all."""
    return run_log.groupBy("logical_date").agg(
        F.count_if(F.col("state") == SUCCESS).alias("success_runs"),
        F.count_if(F.col("state") == FAILED).alias("failed_runs"),
    )


def mean_duration(task_log: DataFrame) -> DataFrame:
    return task_log.groupBy("task_id").agg(F.avg("duration_s").alias("mean_duration_s"))


def failed_tasks(task_log: DataFrame) -> DataFrame:
    return task_log.agg(F.count_if(F.col("state") == FAILED).alias("failed_tasks"))
