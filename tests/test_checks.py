"""Expectations, reconciliation and the completeness gate."""

from __future__ import annotations

from datetime import date

import pytest

from ledgermill.operators import gate, gold, quality, reconcile, silver, validation
from tests.records import bronze, record


def labelled_silver(spark, *records):
    return silver.dedup(silver.to_silver(validation.label(bronze(spark, *records))))


def outcome(df):
    return {(r.check_name, r.column_name): (r.failures, r.failed_rows) for r in df.collect()}


def test_not_null_counts_rows(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, None)], "x string, y int")
    assert outcome(quality.not_null(df, ["x", "y"])) == {
        ("not_null", "x"): (2, 2),
        ("not_null", "y"): (1, 1),
    }


def test_unique_counts_repeated_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "x string")
    assert outcome(quality.unique(df, "x")) == {("unique", "x"): (1, 3)}


def test_accepted_values_lets_null_pass(spark):
    df = spark.createDataFrame([("a",), ("z",), ("z",), ("y",), (None,)], "x string")
    assert outcome(quality.accepted_values(df, "x", ["a"])) == {("accepted_values", "x"): (2, 3)}


def test_accepted_boolean(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "x boolean")
    assert outcome(quality.accepted_values(df, "x", [True])) == {("accepted_values", "x"): (1, 1)}


def test_published_expectations(spark):
    rows = labelled_silver(
        spark,
        record(),
        record(nameOrig="C2", isFraud="1", type="TRANSFER"),
        record(nameOrig="C3", isFraud="1", type="DEBIT"),
        record(nameOrig="C4", isFraud=None),
    )
    tables = {"silver": rows} | {name: build(rows) for name, build in gold.GOLD_TABLES.items()}
    results = quality.evaluate(tables).collect()
    assert len(results) == len(quality.EXPECTATIONS) == 12
    broken = {(r.table_name, r.check_name, r.column_name) for r in results if r.failures}
    assert broken == {
        ("silver", "not_null", "is_suspicious"),
        ("undetected_fraud", "accepted_values", "type"),
    }
    with pytest.raises(quality.ExpectationFailed, match="is_suspicious"):
        quality.check_expectations(results)
    quality.check_expectations([r for r in results if not r.failures])


@pytest.mark.parametrize(
    ("day_rows", "later_rows", "done", "ready"),
    [(100, 50, False, True), (100, 0, True, True), (100, 0, False, False), (0, 10, True, False)],
)
def test_gate_truth_table(spark, day_rows, later_rows, done, ready):
    assert gate.is_ready(day_rows, later_rows, done) is ready
    rows = [record(step="1")] * day_rows + [record(step="30")] * later_rows
    state = gate.day_ready(bronze(spark, *rows), "2016-01-01", done).first()
    assert tuple(state) == (day_rows, later_rows, ready)


def test_gate_ignores_steps_outside_the_span(spark):
    rows = bronze(spark, record(step="700"), record(step="744"), record(step="x1"))
    assert gate.day_ready(rows, "2016-01-30").first().ready is False
    assert gate.day_ready(rows, "2016-01-30", validate_step=False).first().ready is True


def test_ready_days(spark):
    rows = bronze(spark, *[record(step=s) for s in ("1", "2", "49", "744", None)])
    got = {r.tx_date: (r.day_rows, r.ready) for r in gate.ready_days(rows).collect()}
    assert got == {date(2016, 1, 1): (2, True), date(2016, 1, 3): (1, False)}
    assert all(r.ready for r in gate.ready_days(rows, feed_done=True).collect())


def test_total_gate():
    reconcile.check_total(16, 16)
    with pytest.raises(validation.CountMismatch):
        reconcile.check_total(15, 16)


def test_total(spark):
    rows = labelled_silver(spark, record(isFraud="1"), record(nameOrig="C2"))
    gold_rows = gold.undetected_fraud(rows)
    assert tuple(reconcile.total(rows, gold_rows).first()) == (1, 1, True)
    assert tuple(reconcile.total(rows, gold_rows.limit(0)).first()) == (0, 1, False)


def test_days_missing_from_a_layer_count_as_zero(spark):
    rows = labelled_silver(spark, record(isFraud="1"), record(step="25"))
    raw = bronze(spark, record(), record(step="49"), record(step="49"))
    days = reconcile.by_date(
        reconcile.bronze_valid_by_date(raw),
        reconcile.silver_by_date(rows),
        reconcile.gold_by_date(gold.undetected_fraud(rows).limit(0)),
    )
    got = {r.tx_date.day: (r.bronze_rows, r.silver_rows, r.bs_diff, r.sg_diff) for r in days.collect()}
    assert got == {1: (1, 1, 0, 1), 2: (0, 1, -1, 0), 3: (1, 0, 1, 0)}
    assert tuple(reconcile.worst(days).first()) == (1, 1)


def test_mirror_is_stricter_than_the_rules(spark):
    odd = [
        record(nameOrig="C2", isFraud=None),
        record(nameOrig="C3", step="1.5"),
        record(nameOrig="C4", amount="NaN"),
    ]
    raw = bronze(spark, record(), record(kafka_timestamp=5), *odd)
    assert validation.valid_rows(validation.label(raw)).count() == 5
    (day,) = reconcile.bronze_valid_by_date(raw).collect()
    assert day.bronze_rows == 1
