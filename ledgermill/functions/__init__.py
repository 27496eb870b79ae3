from ledgermill.functions.casts import int_prefix, to_flag, to_money, to_number
from ledgermill.functions.records import (
    day_to_millis,
    event_date,
    event_hour,
    event_timestamp,
    ingest_date,
    is_suspicious,
    millis_to_timestamp,
    payload_json,
    row_id,
    row_key,
    step_day_index,
)
from ledgermill.functions.rules import reject_reason

__all__ = [
    "day_to_millis",
    "event_date",
    "event_hour",
    "event_timestamp",
    "ingest_date",
    "int_prefix",
    "is_suspicious",
    "millis_to_timestamp",
    "payload_json",
    "reject_reason",
    "row_id",
    "row_key",
    "step_day_index",
    "to_flag",
    "to_money",
    "to_number",
]
