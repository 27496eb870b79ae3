from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgermill.operators import silver, validation
from ledgermill.schema import SILVER_SCHEMA
from tests.records import bronze, record


def build(spark, *records):
    return silver.to_silver(validation.label(bronze(spark, *records)))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_schema(spark):
    got = build(spark, record())
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in SILVER_SCHEMA
    ]


def test_typed_values(spark):
    (row,) = build(spark, record(step="1.9", amount="2.345", isFraud="1")).collect()
    assert (row.step, row.tx_date, row.amount) == (1, date(2016, 1, 1), Decimal("2.35"))
    assert (row.isFraud, row.isFlaggedFraud, row.is_suspicious) == (1, 0, True)


def test_suspicion_follows_three_valued_logic(spark):
    flags = [("1", "0"), ("1", "1"), ("0", "0"), (None, "0"), ("1", None), (None, "1"), ("0", None)]
    rows = [
        record(nameOrig=f"C{i}", isFraud=fraud, isFlaggedFraud=flagged)
        for i, (fraud, flagged) in enumerate(flags)
    ]
    got = {row.nameOrig: row.is_suspicious for row in build(spark, *rows).collect()}
    assert [got[f"C{i}"] for i in range(len(flags))] == [
        True,
        False,
        False,
        None,
        None,
        False,
        False,
    ]


def test_unreadable_amount_stays_valid_without_a_decimal(spark):
    rows = [record(amount=text) for text in ("NaN", "Infinity", "1e20", "10d")]
    assert [row.amount for row in build(spark, *rows).collect()] == [None] * 4


def test_earliest_copy_survives(spark):
    copies = [
        record(kafka_timestamp=None, newbalanceDest="1.00"),
        record(kafka_timestamp=2000, newbalanceDest="2.00"),
        record(kafka_timestamp=1000, newbalanceDest="4.00"),
        record(kafka_timestamp=1000, newbalanceDest="3.00"),
    ]
    for seed in range(4):
        random.Random(seed).shuffle(copies)
        (row,) = silver.dedup(build(spark, *copies).repartition(3)).collect()
        assert row.newbalanceDest == Decimal("3.00")


def test_raw_text_tells_payments_apart(spark):
    rows = build(spark, record(amount="1"), record(amount="1.0"), record(amount="1.0"))
    assert silver.dedup(rows).count() == 2


def test_hot_payment_is_reduced_before_the_shuffle(spark):
    """A third of all rows are copies of one payment; each task sends one of them."""
    base = build(spark, record())
    rows = spark.range(30000, numPartitions=6).crossJoin(base).withColumns(
        {
            "row_id": F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")),
            "kafka_timestamp": F.timestamp_seconds(F.col("id") + 5),
        }
    )
    kept = silver.dedup(rows.drop("id"))
    plan = plan_of(kept)
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning(row_id")
    assert exchange < partial, "the group limit has to sit below the exchange"
    assert kept.count() == 20001
    hot = kept.filter("row_id = 'hot'").select(F.unix_seconds("kafka_timestamp")).collect()
    assert [row[0] for row in hot] == [5]


def test_one_day(spark):
    rows = build(spark, *[record(step=str(step)) for step in (24, 25, 48, 49)])
    assert silver.event_days(rows, "2016-01-02").count() == 2
    assert silver.event_days(rows, "2016-01-01", date(2016, 1, 2)).count() == 3


def test_summary_counts_every_row_once(spark):
    rng = random.Random(3)
    records = [
        record(
            nameOrig=f"C{rng.randint(1, 40)}",
            amount=rng.choice(["1", "2", "abc", None]),
            isFraud=rng.choice(["0", "1", None, "2"]),
            kafka_timestamp=rng.choice([None, 1, 2, 3]),
        )
        for _ in range(600)
    ]
    labelled = validation.label(bronze(spark, *records))
    kept = silver.dedup(silver.to_silver(labelled))
    valid = validation.valid_rows(labelled).count()
    row = silver.run_summary(labelled).first()
    assert row.bronze_rows == 600
    assert row.valid_rows == valid
    assert row.quarantine_rows == 600 - valid
    assert row.silver_rows == kept.count()
    assert row.dedup_removed == valid - kept.count()
    assert row.suspicious_rows == kept.filter("is_suspicious").count()


def test_summary_of_nothing(spark):
    row = silver.run_summary(validation.label(bronze(spark))).first()
    assert list(row) == [0, 0, 0, 0, 0, 0]


def test_summary_reads_bronze_once(spark):
    summary = silver.run_summary(validation.label(bronze(spark, record())))
    assert plan_of(summary).count("Scan ExistingRDD") == 1
