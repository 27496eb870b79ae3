from __future__ import annotations

import pytest

from ledgermill.plans import panels
from ledgermill.schema import METRICS_SCHEMA
from ledgermill.sources import tables


@pytest.fixture(scope="module")
def metrics(spark, tmp_path_factory):
    rows = [
        ("fraud_by_date_rows", {"d_ms": "1"}, 3.0),
        ("fraud_by_date_rows", {"d_ms": "2"}, 4.0),
        ("fraud_batch_last_success_timestamp_seconds", {}, 1.5),
        ("fraud_mule_recv_count", {"account": "M2"}, 5.0),
        ("fraud_mule_recv_count", {"account": "M1"}, 5.0),
        ("fraud_mule_recv_count", {"account": "M3"}, 9.0),
        ("fraud_dagrun_success", {"d_ms": "1"}, 2.0),
        ("fraud_dagrun_failed", {"d_ms": "1"}, 1.0),
        ("fraud_dagrun_failed", {"d_ms": "2"}, 4.0),
    ]
    path = str(tmp_path_factory.mktemp("metrics") / "table")
    tables.write_metrics(spark.createDataFrame(rows, METRICS_SCHEMA), path)
    return tables.read_metrics(spark, path)


def test_headlines(metrics):
    assert panels.total_rows(metrics).first()[0] == 7.0
    assert panels.last_success_millis(metrics).first()[0] == 1500.0


def test_top_receivers(metrics):
    assert [row.account for row in panels.top_receivers(metrics, 2).collect()] == ["M3", "M1"]


def test_runs_side_by_side(metrics):
    got = {tuple(row) for row in panels.runs_by_day(metrics).collect()}
    assert got == {("1", 2.0, 1.0), ("2", 0.0, 4.0)}


def test_one_gauge_reads_one_partition(metrics):
    plan = panels.gauge(metrics, "fraud_by_date_rows")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(metric" in plan
