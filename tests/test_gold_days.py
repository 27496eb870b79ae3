from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgermill.operators import gold, kpis, partials, quality, reconcile, silver, validation
from ledgermill.plans import gold_days
from ledgermill.plans.bronze_days import read_bronze_days, update_bronze_days
from ledgermill.plans.gold_days import (
    build_gold,
    changed_days,
    day_schema,
    expectations,
    read_day_table,
    read_gold_table,
    update_gold,
)
from ledgermill.sources import tables
from tests.records import bronze, record

FIRST = date(2016, 1, 1)


@pytest.fixture
def lake(spark, tmp_path):
    """Paths, and a function that loads days with the given records, replacing what they held."""
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")

    def load(*records):
        rows = silver.dedup(silver.to_silver(validation.label(bronze(spark, *records))))
        tables.write_silver(rows, silver_path)

    return silver_path, gold_path, load


def pay(day, account, fraud="0", flagged="0", amount="5.00", to="M1", kind="TRANSFER", hour=0):
    return record(
        step=str(24 * day + hour + 1), nameOrig=account, isFraud=fraud, isFlaggedFraud=flagged, amount=amount, nameDest=to, type=kind
    )


def as_set(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def check_equal_to_a_full_build(spark, silver_path, gold_path):
    rows = tables.read_silver(spark, silver_path)
    for name, build in gold.GOLD_TABLES.items():
        assert as_set(read_gold_table(spark, gold_path, name)) == as_set(build(rows)), name
    assert as_set(read_day_table(spark, gold_path, "day_counts")) == as_set(partials.counts(rows))
    top = partials.top_receivers(read_day_table(spark, gold_path, "receiver_days"))
    assert top.collect() == kpis.top_receivers(rows).collect()
    for n in (1, 4, 50):
        found = gold_days.top_receivers(spark, gold_path, n)
        assert found.collect() == kpis.top_receivers(rows, n).collect()
    full = quality.evaluate({"silver": rows} | {name: build(rows) for name, build in gold.GOLD_TABLES.items()})
    assert as_set(expectations(spark, gold_path)) == as_set(full)
    assert read_gold_table(spark, gold_path, "account_risk").dtypes == gold.account_risk(rows).dtypes


def test_days_in_any_order_and_again_equal_a_full_build(spark, lake):
    silver_path, gold_path, load = lake
    rng = random.Random(11)
    for day in [2, 0, 1, 0, 2]:
        load(*[
            pay(day, f"C{rng.randint(0, 12)}", rng.choice("0001"), rng.choice("001"), f"{rng.randint(1, 99)}.25",
                f"M{rng.randint(0, 15)}", rng.choice(["TRANSFER", "CASH_OUT", "PAYMENT"]), rng.randint(0, 23))
            for _ in range(40)
        ])
        assert update_gold(spark, silver_path, gold_path) == [FIRST + timedelta(days=day)]
    check_equal_to_a_full_build(spark, silver_path, gold_path)
    assert update_gold(spark, silver_path, gold_path) == []
    build_gold(spark, silver_path, gold_path)
    check_equal_to_a_full_build(spark, silver_path, gold_path)


def test_what_a_day_added_is_taken_back(spark, lake):
    """An account loses its only fraud, another its last day, a third becomes involved by a late record."""
    silver_path, gold_path, load = lake
    load(pay(0, "A"), pay(0, "B", "1"), pay(0, "C"), pay(1, "A", "1"), pay(1, "B", amount="7.00"), pay(1, "D", "1"))
    update_gold(spark, silver_path, gold_path)
    assert {r.account_id for r in read_gold_table(spark, gold_path, "account_risk").collect()} == {"A", "B", "D"}
    load(pay(1, "A"), pay(1, "C", "1", amount="9.00"))
    assert changed_days(spark, silver_path, gold_path).keys() == {date(2016, 1, 2)}
    update_gold(spark, silver_path, gold_path)
    check_equal_to_a_full_build(spark, silver_path, gold_path)
    risk = {r.account_id: r for r in read_gold_table(spark, gold_path, "account_risk").collect()}
    assert set(risk) == {"B", "C"}
    assert (risk["B"].total_tx_count, risk["B"].last_tx_at.day) == (1, 1)
    assert risk["C"].total_amount == Decimal("14.00")


def test_a_day_without_rows_of_a_table_and_a_day_that_is_gone(spark, lake):
    silver_path, gold_path, load = lake
    load(pay(0, "A", "1"), pay(1, "A", "1"), pay(2, "B", "1"))
    update_gold(spark, silver_path, gold_path)
    load(pay(0, "A", "1", "1"))
    for file in Path(silver_path, "tx_date=2016-01-03").glob("*"):
        file.unlink()
    for file in Path(silver_path, "tx_date=2016-01-03").glob(".*"):
        file.unlink()
    assert update_gold(spark, silver_path, gold_path) == [FIRST, date(2016, 1, 3)]
    assert [r.tx_date.day for r in read_gold_table(spark, gold_path, "undetected_fraud").collect()] == [2]
    check_equal_to_a_full_build(spark, silver_path, gold_path)


def test_a_run_reads_only_its_day_of_silver(spark, lake):
    silver_path, gold_path, load = lake
    load(*[pay(day, f"C{day}", "1") for day in range(3)])
    update_gold(spark, silver_path, gold_path)
    for day in (1, 2):
        for file in Path(silver_path, f"tx_date=2016-01-0{day}").glob("part-*"):
            file.write_bytes(b"not Parquet")
        for crc in Path(silver_path, f"tx_date=2016-01-0{day}").glob(".part-*.crc"):
            crc.unlink()
    load(pay(2, "C0", "1"), pay(2, "C9"))
    assert update_gold(spark, silver_path, gold_path) == [date(2016, 1, 3)]
    risk = {r.account_id: r.total_tx_count for r in read_gold_table(spark, gold_path, "account_risk").collect()}
    assert risk == {"C0": 2, "C1": 1}


def test_untouched_accounts_are_taken_over(spark, lake):
    silver_path, gold_path, load = lake
    load(pay(0, "A", "1"), pay(0, "B", "1"), pay(1, "C"))
    update_gold(spark, silver_path, gold_path)
    marked = read_gold_table(spark, gold_path, "account_risk").withColumn(
        "fraud_rate_pct", F.lit(-1.0)
    )
    tables.write_gold(marked, gold_path, "account_risk")
    load(pay(1, "B"))
    update_gold(spark, silver_path, gold_path)
    rate = {r.account_id: r.fraud_rate_pct for r in read_gold_table(spark, gold_path, "account_risk").collect()}
    assert rate == {"A": -1.0, "B": 50.0}


@pytest.mark.parametrize("step", ["write_gold", "append_version"])
def test_a_run_that_dies_is_made_good_by_the_next(spark, lake, monkeypatch, step):
    silver_path, gold_path, load = lake
    load(pay(0, "A", "1"), pay(0, "B", "1"), pay(1, "A"))
    update_gold(spark, silver_path, gold_path)
    load(pay(0, "A", "1", amount="8.00"))

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(gold_days.tables, step, die)
        with pytest.raises(OSError):
            update_gold(spark, silver_path, gold_path)
    load(pay(1, "D"))
    update_gold(spark, silver_path, gold_path)
    check_equal_to_a_full_build(spark, silver_path, gold_path)


def test_expectations_that_fail_add_up(spark, lake):
    silver_path, gold_path, load = lake
    rows = silver.dedup(silver.to_silver(validation.label(bronze(spark, pay(0, "A", "1"), pay(1, "B", "1")))))
    odd = rows.withColumn("type", F.lit("WIRE"))
    twice = odd.unionByName(odd.limit(1)).unionByName(odd.withColumn("is_suspicious", F.lit(None).cast("boolean")).withColumn("row_id", F.lit(None).cast("string")))
    tables.write_silver(twice, silver_path)
    update_gold(spark, silver_path, gold_path)
    check_equal_to_a_full_build(spark, silver_path, gold_path)
    found = {(r.table_name, r.check_name, r.column_name): (r.failures, r.failed_rows) for r in expectations(spark, gold_path).collect()}
    assert found["silver", "accepted_values", "type"] == (1, 5)
    assert found["silver", "unique", "row_id"] == (1, 2)


def test_empty_silver(spark, lake):
    silver_path, gold_path, _ = lake
    assert update_gold(spark, silver_path, gold_path) == []
    assert read_gold_table(spark, gold_path, "account_risk").count() == 0
    assert read_gold_table(spark, gold_path, "hourly_summary").count() == 0
    assert {r.failures for r in expectations(spark, gold_path).collect()} == {0}


def write_receivers(spark, gold_path, rows):
    """Daily counts of receivers and their heads as a run leaves them, from ``nameDest, tx_date, recv_count``."""
    table = spark.createDataFrame(rows, "nameDest string, tx_date date, recv_count long") if isinstance(rows, list) else rows
    columns = day_schema(spark, "receiver_days").fieldNames()
    order = Window.partitionBy("tx_date").orderBy(F.desc("recv_count"), "nameDest")
    heads = table.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= partials.HEAD)
    days = [r.tx_date for r in table.select("tx_date").distinct().collect()]
    for name, part in {"receiver_days": table, "receiver_heads": heads}.items():
        tables.replace_days(part.select(columns), f"{gold_path}/{name}", days, partials.DAY_ORDER.get(name, ()))
    return table


@pytest.mark.parametrize("seed", range(4))
def test_top_receivers_by_threshold_equal_the_full_sum(spark, tmp_path, monkeypatch, seed):
    """Small heads, many equal totals, and receivers that are large only over all days together."""
    monkeypatch.setattr(partials, "HEAD", 3)
    monkeypatch.setattr(partials, "MOST_NAMES", (0, 1, 200, 200)[seed])
    rng = random.Random(seed)
    rows = [
        (f"M{name:03d}", FIRST + timedelta(days=day), rng.choice([1, 1, 2, 3, 30 if name < 12 else 4]))
        for day in range(6) for name in range(60) if rng.random() < 0.6
    ]
    rows += [("steady", FIRST + timedelta(days=day), 4) for day in range(6)]
    table = write_receivers(spark, str(tmp_path), rows)
    for n in (1, 2, 5, 17, 100):
        found = gold_days.top_receivers(spark, str(tmp_path), n)
        assert found.collect() == partials.top_receivers(table, n).collect()


def test_heads_older_than_the_counts_do_no_harm(spark, tmp_path):
    """Heads still hold a receiver whose payments were taken back."""
    path = str(tmp_path)
    old = [("A", FIRST, 90), ("B", FIRST, 80)] + [(f"M{i}", FIRST, 1 + i % 3) for i in range(30)]
    write_receivers(spark, path, old)
    now = spark.createDataFrame(old[2:], "nameDest string, tx_date date, recv_count long")
    columns = day_schema(spark, "receiver_days").fieldNames()
    tables.replace_days(now.select(columns), f"{path}/receiver_days", [FIRST], partials.DAY_ORDER["receiver_days"])
    assert gold_days.top_receivers(spark, path, 2).collect() == partials.top_receivers(now, 2).collect()


def rows_scanned(df) -> int:
    """Rows that the file scans of an executed frame handed on, after skipped row groups and pages."""
    def scans(plan):
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            return scans(plan.executedPlan())
        if "QueryStage" in plan.nodeName():
            return scans(plan.plan())
        if plan.nodeName().startswith("Scan parquet"):
            return plan.metrics().apply("numOutputRows").value()
        return sum(scans(plan.children().apply(i)) for i in range(plan.children().size()))

    df.collect()
    return scans(df._jdf.queryExecution().executedPlan())


def test_top_receivers_read_a_share_of_the_counts(spark, tmp_path):
    """Nearly all receivers have one payment on a day; pages of these are skipped."""
    path, n_days, each = str(tmp_path), 4, 150_000
    many = spark.range(n_days * each).selectExpr(
        "concat('M', lpad(cast(id % 150000 as string), 7, '0')) as nameDest",
        f"date_add(date'{FIRST}', cast(id div {each} as int)) as tx_date",
        "case when id % 150000 < 40 then 100 + id % 40 else 1 end as recv_count",
    )
    table = write_receivers(spark, path, many)
    counts = read_day_table(spark, path, "receiver_days")
    sure = partials.nth_total(partials.top_receivers(read_day_table(spark, path, "receiver_heads"), 10), 10)
    found = partials.top_by_threshold(counts, n_days, 10, sure)
    share = rows_scanned(found) / rows_scanned(partials.top_receivers(counts, 10))
    assert found.collect() == partials.top_receivers(table, 10).collect()
    assert share < 0.5, share


def test_daily_counts_are_sorted_without_another_shuffle(spark, tmp_path):
    path = str(tmp_path)
    write_receivers(spark, path, [(f"M{i % 40}", FIRST + timedelta(days=i // 40), 40 - i % 40) for i in range(120)])
    for file in Path(path, "receiver_days").glob("*/part-*"):
        rows = [tuple(r) for r in spark.read.parquet(str(file)).select("recv_count", "nameDest").collect()]
        assert rows == sorted(rows)


DAY = 86_400_000


def test_bronze_counts_by_ingest_day(spark, tmp_path):
    """Redelivery on another ingest day counts once; an ingest day read again replaces its keys."""
    path = str(tmp_path / "days")

    def take_in(*records):
        marked = bronze(spark, *records).withColumn("day", reconcile.mirror_day())
        update_bronze_days(reconcile.bronze_keys(marked, "day"), path)
        return {r.tx_date.day: r.bronze_rows for r in read_bronze_days(spark, path).collect()}

    assert take_in() == {}
    one = [pay(0, "A"), pay(0, "B"), pay(0, "B"), pay(1, "A"), pay(0, "bad", amount="abc")]
    assert take_in(*one) == {1: 2, 2: 1}
    late = [r | {"kafka_timestamp": r["kafka_timestamp"] + DAY} for r in (pay(0, "B"), pay(0, "C"))]
    assert take_in(*late) == {1: 3, 2: 1}
    assert take_in(*one, pay(1, "D")) == {1: 3, 2: 2}
    undated = pay(2, "E") | {"kafka_timestamp": None}
    assert take_in(undated) == {1: 3, 2: 2, 3: 1}
    every = [*one, pay(1, "D"), *late, undated]
    full = reconcile.bronze_valid_by_date(bronze(spark, *every)).collect()
    assert {r.tx_date.day: r.bronze_rows for r in full} == {1: 3, 2: 2, 3: 1}
