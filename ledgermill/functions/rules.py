"""Quality rules of a Bronze record."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.casts import int_prefix, to_money, to_number
from ledgermill.schema import (
    FIRST_STEP,
    FLAG_VALUES,
    LAST_STEP,
    PAYMENT_TYPES,
    REQUIRED_FIELDS,
)


def _missing_field() -> Column:
    return reduce(or_, [F.col(name).isNull() for name in REQUIRED_FIELDS])


def _fails(condition: Column) -> Column:
    """Broken unless the condition is true; an unreadable value makes it NULL, so it breaks too."""
    return ~F.coalesce(condition, F.lit(False))


def _bad_amount(strict: bool) -> Column:
    bad = _fails(to_number("amount") > 0)
    return bad | to_money("amount").isNull() if strict else bad


def _bad_step() -> Column:
    return _fails(int_prefix("step").between(FIRST_STEP, LAST_STEP))


def reject_reason(strict: bool = False) -> Column:
    """Name of the first rule that a record breaks, NULL for a valid one.

    A rule whose condition is NULL counts as kept, so an absent flag or balance is accepted.
    ``strict`` also rejects amounts that are numbers but no DECIMAL(18,2), such as ``'1e20'``.
    """
    # Reason names and their precedence.
    rules = [
        ("parse_error", _missing_field()),
        ("invalid_amount", _bad_amount(strict)),
        ("invalid_step", _bad_step()),
        ("invalid_type", ~F.col("type").isin(PAYMENT_TYPES)),
        ("invalid_flag", ~F.col("isFraud").isin(FLAG_VALUES)),
        ("invalid_flag", ~F.col("isFlaggedFraud").isin(FLAG_VALUES)),
        ("negative_balance", to_number("oldbalanceOrg") < 0),
        ("negative_balance", to_number("newbalanceOrig") < 0),
    ]
    return F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in rules])
