from __future__ import annotations

import pytest

from ledgermill.operators import validation
from tests.records import bronze, record

CASES = [
    ({}, None),
    ({"step": None}, "parse_error"),
    ({"amount": None}, "parse_error"),
    ({"nameOrig": None}, "parse_error"),
    ({"type": None}, "parse_error"),
    ({"nameDest": None}, "parse_error"),
    ({"amount": "abc"}, "invalid_amount"),
    ({"amount": ""}, "invalid_amount"),
    ({"amount": "0.00"}, "invalid_amount"),
    ({"amount": "-1"}, "invalid_amount"),
    ({"amount": "-0"}, "invalid_amount"),
    ({"amount": "1,000"}, "invalid_amount"),
    ({"step": "0"}, "invalid_step"),
    ({"step": "744"}, "invalid_step"),
    ({"step": "x1"}, "invalid_step"),
    ({"step": "-5"}, "invalid_step"),
    ({"step": "743"}, None),
    ({"step": "1.5"}, None),
    ({"step": "743.9"}, None),
    ({"step": ".5"}, "invalid_step"),
    ({"type": "WIRE"}, "invalid_type"),
    ({"type": "payment"}, "invalid_type"),
    ({"isFraud": "2"}, "invalid_flag"),
    ({"isFlaggedFraud": "Y"}, "invalid_flag"),
    ({"isFraud": None}, None),
    ({"isFlaggedFraud": None}, None),
    ({"oldbalanceOrg": "-0.01"}, "negative_balance"),
    ({"newbalanceOrig": "-1"}, "negative_balance"),
    ({"oldbalanceOrg": None}, None),
    ({"oldbalanceOrg": "abc"}, None),
    ({"oldbalanceDest": "-1"}, None),
    ({"newbalanceDest": "-1"}, None),
    ({"amount": "NaN"}, None),
    ({"amount": "Infinity"}, None),
    ({"amount": "10d"}, None),
    ({"amount": "1e20"}, None),
    # Several rules broken at once: the first one names the reason.
    ({"step": None, "amount": "abc", "type": "WIRE"}, "parse_error"),
    ({"amount": "abc", "step": "0", "type": "WIRE"}, "invalid_amount"),
    ({"step": "0", "type": "WIRE", "isFraud": "2"}, "invalid_step"),
    ({"type": "WIRE", "isFraud": "2", "oldbalanceOrg": "-1"}, "invalid_type"),
    ({"isFlaggedFraud": "Y", "oldbalanceOrg": "-1"}, "invalid_flag"),
]


@pytest.fixture(scope="module")
def reasons(spark):
    rows = [record(nameOrig=f"C{i}") | changes for i, (changes, _) in enumerate(CASES)]
    labelled = validation.label(bronze(spark, *rows))
    return [row.reject_reason for row in labelled.collect()]


@pytest.mark.parametrize("position", range(len(CASES)), ids=[str(case[0]) for case in CASES])
def test_reason(reasons, position):
    assert reasons[position] == CASES[position][1]


def test_strict_rejects_amounts_without_a_decimal(spark):
    rows = [record(amount=text) for text in ("1e20", "NaN", "Infinity", "10d", "1e3")]
    labelled = validation.label(bronze(spark, *rows), strict=True)
    assert [row.reject_reason for row in labelled.collect()] == ["invalid_amount"] * 4 + [None]


def test_split_is_complete(spark):
    rows = [record() | changes for changes, _ in CASES]
    labelled = validation.label(bronze(spark, *rows))
    counts = validation.conservation(labelled).first()
    assert counts.conserved
    assert counts.bronze_rows == len(CASES)
    assert counts.valid_rows == validation.valid_rows(labelled).count()
    assert counts.quarantine_rows == validation.to_quarantine(labelled).count()


def test_lost_rows_stop_the_run():
    validation.check_conservation(5, 3, 2)
    with pytest.raises(validation.CountMismatch):
        validation.check_conservation(5, 3, 1)
