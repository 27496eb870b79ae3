"""Text to number conversions that give NULL for bad text under any ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.schema import MONEY

# An integer with a point and an optional fraction, padded by blanks or control
# characters; and any digit.
INT_WITH_POINT = r"^[\x00-\x20\x7f]*[+-]?[0-9]*[.][0-9]*[\x00-\x20\x7f]*$"
DIGIT = "[0-9]"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(value: Column | str) -> Column:
    return _column(value).try_cast("double")


def to_money(value: Column | str) -> Column:
    return _column(value).try_cast(MONEY)


def to_flag(value: Column | str) -> Column:
    return _column(value).try_cast("int")


def int_prefix(value: Column | str) -> Column:
    """Integer part of a text number: ``'1.99'`` is 1, ``'.5'`` is 0, ``'1e3'`` is NULL.

    Plain integers, practically all rows, take the cheap cast; only other text reaches the regular
    expression.
    """
    text = _column(value)
    whole = F.substring_index(text, ".", 1)
    truncated = F.when(whole.rlike(DIGIT), whole.try_cast("int")).otherwise(0)
    return F.coalesce(text.try_cast("int"), F.when(text.rlike(INT_WITH_POINT), truncated))
