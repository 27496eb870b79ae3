"""Has an event day arrived as a whole?

A day is complete once it has records and either a later day has records too or the feed is done.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import event_date
from ledgermill.schema import FIRST_STEP, LAST_STEP, STEP_EPOCH, as_day


def arrival_day(step_epoch: str = STEP_EPOCH, validate_step: bool = True) -> Column:
    """Event day of a Bronze record, NULL where its step is no integer.

    By default steps outside the accepted span do not count: a stray later step would otherwise
    declare the last day complete. ``validate_step=False`` counts every integer.
    """
    step = F.col("step").try_cast("int")
    day = event_date(step, step_epoch)
    return F.when(step.between(FIRST_STEP, LAST_STEP), day) if validate_step else day


def is_ready(day_rows: int, later_rows: int, done: bool) -> bool:
    return day_rows > 0 and (later_rows > 0 or done)


def day_ready(
    bronze: DataFrame,
    day: str | date,
    feed_done: bool = False,
    step_epoch: str = STEP_EPOCH,
    validate_step: bool = True,
) -> DataFrame:
    """One row ``day_rows, later_rows, ready`` for a day, in a single pass without a shuffle."""
    target = F.lit(as_day(day))
    arrived = arrival_day(step_epoch, validate_step)
    return (
        bronze.select(arrived.alias("tx_date"))
        .agg(
            F.count_if(F.col("tx_date") == target).alias("day_rows"),
            F.count_if(F.col("tx_date") > target).alias("later_rows"),
        )
        .withColumn(
            "ready",
            (F.col("day_rows") > 0) & ((F.col("later_rows") > 0) | F.lit(feed_done)),
        )
    )


def day_ready_from(arrivals: DataFrame, day: str | date, feed_done: bool = False) -> DataFrame:
    """The same row from per-day counts ``tx_date, day_rows``, as ``arrived_by_day`` or the stream keeps them."""
    target = F.lit(as_day(day))

    def rows(days: Column) -> Column:
        return F.coalesce(F.sum(F.when(days, F.col("day_rows"))), F.lit(0))

    return arrivals.agg(
        rows(F.col("tx_date") == target).alias("day_rows"),
        rows(F.col("tx_date") > target).alias("later_rows"),
    ).withColumn(
        "ready", (F.col("day_rows") > 0) & ((F.col("later_rows") > 0) | F.lit(feed_done))
    )


def arrived_by_day(
    bronze: DataFrame, step_epoch: str = STEP_EPOCH, validate_step: bool = True
) -> DataFrame:
    """``tx_date, day_rows`` of every event day seen."""
    return (
        bronze.select(arrival_day(step_epoch, validate_step).alias("tx_date"))
        .filter("tx_date IS NOT NULL")
        .groupBy("tx_date")
        .agg(F.count(F.lit(1)).alias("day_rows"))
    )


def ready_days(
    bronze: DataFrame,
    feed_done: bool = False,
    step_epoch: str = STEP_EPOCH,
    validate_step: bool = True,
) -> DataFrame:
    """``tx_date, day_rows, ready`` of every day seen; all days but the last have a later one."""
    return ready_days_from(arrived_by_day(bronze, step_epoch, validate_step), feed_done)


def ready_days_from(arrivals: DataFrame, feed_done: bool = False) -> DataFrame:
    """The same from per-day counts.

    The last day comes from these counts too. It takes the count along, which it has no use for, so
    that both readers share one exchange and what is counted is read once.
    """
    last = arrivals.agg(F.max_by("tx_date", F.struct("tx_date", "day_rows")))
    later_day_seen = F.col("tx_date") < last.scalar()
    return arrivals.withColumn("ready", later_day_seen | F.lit(feed_done))
