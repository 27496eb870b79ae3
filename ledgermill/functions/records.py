"""Columns derived from one payment record.

Days and hours are computed from epoch seconds and not by ``to_date`` or ``date_trunc``, so they are
those of UTC whatever the session's time zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.casts import int_prefix
from ledgermill.schema import (
    CORRUPT_FIELD,
    PAYLOAD_FIELDS,
    RAW_VALUE_FIELD,
    ROW_KEY_FIELDS,
    ROW_KEY_SEPARATOR,
    STEP_EPOCH,
    epoch_seconds,
)

SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400
MILLIS_PER_DAY = SECONDS_PER_DAY * 1000

# Microseconds of a timestamp fill a 64-bit integer.
MOST_MILLIS = (2**63 - 1) // 1000


def _event_seconds(step: Column, step_epoch: str) -> Column:
    return F.lit(epoch_seconds(step_epoch)) + (step.cast("bigint") - 1) * SECONDS_PER_HOUR


def event_timestamp(step: Column, step_epoch: str = STEP_EPOCH) -> Column:
    """Instant at which an integer step begins."""
    return F.timestamp_seconds(_event_seconds(step, step_epoch))


def event_date(step: Column, step_epoch: str = STEP_EPOCH) -> Column:
    """UTC day of an integer step."""
    days = F.floor(_event_seconds(step, step_epoch) / SECONDS_PER_DAY)
    return F.date_from_unix_date(days.try_cast("int"))


def event_hour(moment: Column | str) -> Column:
    """Instant at which a timestamp's UTC hour begins, also in zones off by half an hour."""
    hours = F.floor(F.unix_seconds(moment) / SECONDS_PER_HOUR)
    return F.timestamp_seconds(hours * SECONDS_PER_HOUR)


def step_day_index(step: Column | str) -> Column:
    """Number of whole days between the first step and a text step."""
    return F.floor((int_prefix(step) - 1) / 24)


def millis_to_timestamp(millis: Column | str) -> Column:
    """NULL for values beyond the range of timestamps, which would otherwise fail the query."""
    value = F.col(millis) if isinstance(millis, str) else millis
    return F.when(value.between(-MOST_MILLIS, MOST_MILLIS), F.timestamp_millis(value))


def ingest_date(millis: Column | str) -> Column:
    """UTC day of an epoch-milliseconds record time."""
    value = F.col(millis) if isinstance(millis, str) else millis
    return F.date_from_unix_date(F.floor(value / MILLIS_PER_DAY).try_cast("int"))


def day_to_millis(day: Column | str) -> Column:
    """Epoch milliseconds of a UTC midnight."""
    return F.unix_date(day).cast("bigint") * MILLIS_PER_DAY


def row_key() -> Column:
    """The raw text that identifies a payment."""
    return F.concat_ws(ROW_KEY_SEPARATOR, *ROW_KEY_FIELDS)


def row_id() -> Column:
    return F.sha2(row_key(), 256)


def is_suspicious(fraud: Column, flagged: Column) -> Column:
    """Fraud that the existing rule did not flag; NULL while a deciding flag is unknown."""
    return (fraud == 1) & (flagged == 0)


def payload_json(columns: list[str]) -> Column:
    """The record as it came in: its own text where that was unreadable, else its fields as JSON."""
    rebuilt = F.to_json(F.struct(*PAYLOAD_FIELDS))
    originals = [F.col(name) for name in (CORRUPT_FIELD, RAW_VALUE_FIELD) if name in columns]
    return F.coalesce(*originals, rebuilt)
