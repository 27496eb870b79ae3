from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

import pytest

from ledgermill.operators import gold, kpis, silver, validation
from ledgermill.schema import PAYMENT_TYPES
from tests.records import bronze, record


@pytest.fixture(scope="module")
def payments(spark):
    rng = random.Random(11)
    records = [
        record(
            step=str(rng.randint(1, 60)),
            type=rng.choice(PAYMENT_TYPES),
            # One account sends a third of all payments.
            nameOrig="C0" if n % 3 == 0 else f"C{rng.randint(1, 30)}",
            nameDest=f"M{rng.randint(1, 12)}",
            amount=f"{rng.randint(1, 99999) / 100:.2f}",
            newbalanceDest=f"{rng.randint(0, 999)}.50",
            isFraud=rng.choices(["0", "1", None], [8, 2, 1])[0],
            isFlaggedFraud=rng.choices(["0", "1", None], [8, 2, 1])[0],
        )
        for n in range(900)
    ]
    rows = silver.dedup(silver.to_silver(validation.label(bronze(spark, *records)))).cache()
    yield rows
    rows.unpersist()


def test_undetected(payments):
    got = gold.undetected_fraud(payments)
    expected = [row for row in payments.collect() if row.isFraud == 1 and row.isFlaggedFraud == 0]
    assert got.count() == len(expected) > 0
    assert len(got.columns) == 16
    by_id = {row.row_id: row for row in expected}
    for row in got.collect():
        source = by_id[row.row_id]
        assert row.orig_balance_drop == source.oldbalanceOrg - source.newbalanceOrig
        assert row.dest_balance_gain == source.newbalanceDest - source.oldbalanceDest


def _totals(rows, key):
    groups = defaultdict(lambda: [0, Decimal(0), 0, 0, Decimal(0)])
    for row in rows:
        group = groups[key(row)]
        group[0] += 1
        group[1] += row.amount
        if row.isFraud == 1:
            group[2] += 1
            group[4] += row.amount
        group[3] += row.is_suspicious is True
    return groups


def test_hourly(payments):
    rows = payments.collect()
    expected = _totals(rows, lambda r: (r.tx_timestamp.replace(minute=0, second=0), r.type))
    got = {
        (r.tx_hour, r.type): [
            r.tx_count,
            r.total_amount,
            r.fraud_count,
            r.suspicious_count,
            r.fraud_amount,
        ]
        for r in gold.hourly_summary(payments).collect()
    }
    assert got == dict(expected)


def test_account_risk(payments):
    rows = payments.collect()
    expected = {k: v for k, v in _totals(rows, lambda r: r.nameOrig).items() if v[2]}
    got = gold.account_risk(payments).collect()
    assert {
        r.account_id: [
            r.total_tx_count,
            r.total_amount,
            r.fraud_tx_count,
            r.suspicious_tx_count,
            r.fraud_amount,
        ]
        for r in got
    } == expected
    for r in got:
        assert r.fraud_rate_pct == pytest.approx(r.fraud_tx_count / r.total_tx_count * 100, abs=0.01)
        assert r.last_tx_at == max(x.tx_timestamp for x in rows if x.nameOrig == r.account_id)


def test_hot_account_is_summed_before_the_shuffle(payments):
    plan = gold.account_risk(payments)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(nameOrig") < plan.index("partial_sum")


def test_sorted_on_read(payments):
    hourly = gold.sorted_hourly(gold.hourly_summary(payments)).collect()
    assert hourly == sorted(hourly, key=lambda r: (r.tx_hour, r.type))
    accounts = gold.sorted_accounts(gold.account_risk(payments)).collect()
    assert accounts == sorted(accounts, key=lambda r: (-r.fraud_amount, r.account_id))


def test_rollups_add_up(payments):
    hourly = gold.hourly_summary(payments)
    total, fraud = payments.count(), payments.filter("isFraud = 1").count()
    for rollup in (kpis.by_hour(hourly), kpis.by_type(hourly)):
        rows = rollup.collect()
        assert sum(r.tx_count for r in rows) == total
        assert sum(r.fraud_count for r in rows) == fraud


def test_confusion(payments):
    rows = payments.collect()
    row = kpis.confusion(payments).first()
    pairs = [(r.isFraud, r.isFlaggedFraud) for r in rows]
    assert row.actual == sum(f == 1 for f, _ in pairs)
    assert row.flagged == sum(g == 1 for _, g in pairs)
    assert row.true_positive == pairs.count((1, 1))
    assert row.false_positive == pairs.count((0, 1))
    assert row.false_negative == pairs.count((1, 0))
    quality = kpis.rule_quality(kpis.confusion(payments)).first()
    assert quality.rule_precision == pytest.approx(row.true_positive / row.flagged)
    assert quality.rule_recall == pytest.approx(row.true_positive / row.actual)


def test_rule_quality_of_nothing_is_zero(payments):
    quality = kpis.rule_quality(kpis.confusion(payments.limit(0))).first()
    assert list(quality) == [0.0, 0.0]


def test_top_receivers_break_ties_by_name(payments):
    counts = defaultdict(int)
    for row in payments.filter("isFraud = 1").collect():
        counts[row.nameDest] += 1
    expected = sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:10]
    top = kpis.top_receivers(payments)
    assert [tuple(row) for row in top.collect()] == expected
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
