from __future__ import annotations

import random
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest

from ledgermill.__main__ import _message_options, _parser, main
from ledgermill.operators import quality, runlog, silver, validation
from ledgermill.operators.validation import CountMismatch
from ledgermill.plans import metrics as metrics_plan
from ledgermill.plans import run as run_plan
from ledgermill.plans.gold_days import read_gold_table
from ledgermill.plans.run import Lake, all_days, load_silver, run_day, run_days
from ledgermill.schema import RUN_LOG_SCHEMA, TASK_LOG_SCHEMA
from ledgermill.sources import tables
from ledgermill.sources.bronze import read_bronze, write_bronze
from tests.records import bronze, record

# Every gauge that has to be published.
GAUGES = {
    "fraud_undetected_total",
    "fraud_suspicious_total",
    "fraud_actual_total",
    "fraud_flagged_total",
    "fraud_true_positive_total",
    "fraud_false_positive_total",
    "fraud_rule_precision",
    "fraud_rule_recall",
    "fraud_batch_last_success_timestamp_seconds",
    "fraud_reconcile_match",
    "fraud_by_date_rows",
    "fraud_by_date_fraud",
    "fraud_by_date_bs_diff",
    "fraud_by_date_sg_diff",
    "fraud_by_hour_tx",
    "fraud_by_hour_fraud",
    "fraud_type_tx",
    "fraud_type_fraud",
    "fraud_mule_recv_count",
    "fraud_dagrun_success",
    "fraud_dagrun_failed",
}


def payments(seed: int, count: int = 240) -> list[dict]:
    """Three event days, some rejects, some copies; fraud only in the types that allow it."""
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        kind = rng.choice(["PAYMENT", "TRANSFER", "CASH_OUT"])
        fraud = "1" if kind != "PAYMENT" and rng.random() < 0.3 else "0"
        row = record(
            step=str(rng.randint(1, 72)),
            type=kind,
            nameOrig=f"C{n % 30}",
            nameDest=f"M{rng.randint(1, 9)}",
            amount=rng.choice([f"{n + 1}.50", f"{n + 1}.50", "abc"]),
            isFraud=fraud,
            isFlaggedFraud="1" if fraud == "1" and rng.random() < 0.4 else "0",
            kafka_timestamp=1767225600000 + n * 60000,
        )
        rows.append(row)
        if n % 7 == 0:
            rows.append(row | {"kafka_timestamp": row["kafka_timestamp"] + 5})
    return rows


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake.below(str(tmp_path / "lake"))
    write_bronze(bronze(spark, *payments(1)), made.bronze)
    return made


def stored(spark, lake) -> set:
    return set(tables.read_silver(spark, lake.silver).collect())


def load(spark, lake, start, end=None, feed_done=True):
    return load_silver(spark, read_bronze(spark, lake.bronze), lake.silver, start, end, feed_done)


def test_range_run(spark, lake):
    report = run_days(spark, lake, "2016-01-01", "2016-01-03", feed_done=True)
    labelled = validation.label(read_bronze(spark, lake.bronze))
    expected = silver.run_summary(labelled).first()
    assert report.ready == [date(2016, 1, day) for day in (1, 2, 3)]
    assert report.bronze_rows == expected.bronze_rows
    assert report.valid_rows == expected.valid_rows
    assert report.quarantine_rows == expected.quarantine_rows
    assert report.dedup_removed == expected.dedup_removed > 0
    assert report.silver_rows == expected.silver_rows
    assert report.suspicious_rows == expected.suspicious_rows > 0
    assert stored(spark, lake) == set(silver.dedup(silver.to_silver(labelled)).collect())
    assert tables.read_quarantine(spark, lake.silver).count() == expected.quarantine_rows
    undetected = read_gold_table(spark, lake.gold, "undetected_fraud")
    assert undetected.count() == expected.suspicious_rows


def test_all_gauges_are_published(spark, lake):
    run_day(spark, lake, "2016-01-01")
    run_day(spark, lake, "2016-01-02")
    metrics = tables.read_metrics(spark, lake.metrics)
    assert {row.metric for row in metrics.select("metric").distinct().collect()} == GAUGES
    flat = {(r.metric, r.label_value): r.value for r in metrics_plan.flat(metrics).collect()}
    assert flat["fraud_reconcile_match", ""] == 1.0
    assert flat["fraud_dagrun_success", "1451606400000"] == 1.0
    assert flat["fraud_by_date_bs_diff", "1451606400000"] == 0.0
    assert 0 < flat["fraud_rule_recall", ""] < 1
    silver_rows = tables.read_silver(spark, lake.silver).count()
    days = [value for (name, _), value in flat.items() if name == "fraud_by_date_rows"]
    assert sum(days) == silver_rows


def test_a_first_run_publishes_every_gauge(spark, lake):
    run_day(spark, lake, "2016-01-01")
    metrics = metrics_plan.flat(tables.read_metrics(spark, lake.metrics))
    flat = {(r.metric, r.label_value): r.value for r in metrics.collect()}
    assert {metric for metric, _ in flat} == GAUGES
    assert flat["fraud_dagrun_success", "1451606400000"] == 0.0


def test_windowed_runs_publish_what_a_full_run_does(spark, lake, tmp_path):
    other = replace(lake, **{n: str(tmp_path / n) for n in ("silver", "gold", "metrics", "run_log", "task_log")})
    options = {"feed_done": True, "raise_on_expectation": False}
    for day in ("2016-01-01", "2016-01-02", "2016-01-03"):
        run_day(spark, lake, day, **options)
        run_day(spark, other, day, ingest_from="1970-01-01", ingest_to="2030-01-01", **options)
    assert stored(spark, lake) == stored(spark, other)

    def gauges(of):
        rows = metrics_plan.flat(tables.read_metrics(spark, of.metrics)).collect()
        return {tuple(r) for r in rows if r.metric != metrics_plan.LAST_SUCCESS_GAUGE}

    assert gauges(lake) == gauges(other)


def test_a_window_keeps_the_differences_of_other_days(spark, lake):
    options = {"feed_done": True, "raise_on_expectation": False}
    run_days(spark, lake, "2016-01-01", "2016-01-03", **options)
    before = tables.read_metrics(spark, lake.metrics).filter(f"metric = '{metrics_plan.BRONZE_GAUGE}'").collect()
    run_day(spark, lake, "2016-01-02", ingest_from="2026-01-01", ingest_to="2030-01-01", **options)
    after = tables.read_metrics(spark, lake.metrics).filter(f"metric = '{metrics_plan.BRONZE_GAUGE}'").collect()
    assert len(after) == len(before) == 3


def test_a_window_reads_only_its_folders(spark, lake):
    plan = read_bronze(spark, lake.bronze, "2026-01-01", "2026-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2026-01-01" in plan


def test_limit_and_checkpoint_exclude_each_other(spark, capsys):
    with pytest.raises(SystemExit):
        main(["publish", "--csv", "c", "--servers", "s", "--topic", "t", "--limit", "5", "--checkpoint", "p"])
    assert "--limit" in capsys.readouterr().err


def test_repeating_a_day_changes_nothing(spark, lake):
    load(spark, lake, "2016-01-02")
    before = stored(spark, lake)
    report = load(spark, lake, "2016-01-02")
    assert stored(spark, lake) == before
    assert report.silver_rows == len(before)


def test_day_by_day_equals_one_range(spark, lake, tmp_path):
    load(spark, lake, "2016-01-01", "2016-01-03")
    in_one_go = stored(spark, lake)
    single = replace(lake, silver=str(tmp_path / "single"))
    for day in ("2016-01-02", "2016-01-01", "2016-01-03"):
        load(spark, single, day)
    assert stored(spark, single) == in_one_go


def test_redelivery_of_everything_changes_nothing(spark, lake):
    load(spark, lake, "2016-01-01", "2016-01-03")
    before = stored(spark, lake)
    again = [r | {"kafka_timestamp": r["kafka_timestamp"] + 10**8} for r in payments(1)]
    write_bronze(bronze(spark, *again), lake.bronze)
    load(spark, lake, "2016-01-01", "2016-01-03")
    assert stored(spark, lake) == before


def test_late_payment_is_picked_up_by_a_rerun(spark, lake):
    load(spark, lake, "2016-01-01")
    count = len(stored(spark, lake))
    write_bronze(bronze(spark, record(nameOrig="LATE")), lake.bronze)
    load(spark, lake, "2016-01-01")
    assert len(stored(spark, lake)) == count + 1


def test_incomplete_day_waits(spark, lake):
    report = load(spark, lake, "2016-01-02", "2016-01-05", feed_done=False)
    assert report.ready == [date(2016, 1, 2)]
    assert report.not_ready == [date(2016, 1, day) for day in (3, 4, 5)]
    assert {row.tx_date for row in stored(spark, lake)} == {date(2016, 1, 2)}
    nothing = run_day(spark, lake, "2016-01-09", feed_done=True)
    assert (nothing.ready, nothing.not_ready) == ([], [date(2016, 1, 9)])


def test_day_of_rejects_only_is_reported(spark, tmp_path):
    lake = Lake.below(str(tmp_path))
    write_bronze(bronze(spark, record(amount="abc"), record(step="25", isFraud="0")), lake.bronze)
    report = load(spark, lake, "2016-01-01", "2016-01-02")
    assert report.without_rows == [date(2016, 1, 1)]
    assert report.silver_rows == 1


@pytest.mark.parametrize("end", [None, "2016-01-02"])
@pytest.mark.parametrize(("amount", "written", "rejected"), [("1", 2, 0), ("abc", 0, 2)])
def test_one_of_the_outputs_is_empty(spark, tmp_path, end, amount, written, rejected):
    lake = Lake.below(str(tmp_path))
    rows = [record(amount=amount, nameOrig=name) for name in ("C1", "C2")]
    write_bronze(bronze(spark, *rows), lake.bronze)
    report = load(spark, lake, "2016-01-01", end)
    assert (report.silver_rows, report.quarantine_rows) == (written, rejected)
    assert (report.suspicious_rows, report.dedup_removed) == (0, 0)


def test_failed_expectation_stops_the_run(spark, lake):
    write_bronze(bronze(spark, record(nameOrig="C99", isFraud=None)), lake.bronze)
    with pytest.raises(quality.ExpectationFailed, match="is_suspicious"):
        run_day(spark, lake, "2016-01-01")
    assert not Path(lake.metrics).exists()
    entries = tables.read_log(spark, lake.run_log, RUN_LOG_SCHEMA).collect()
    assert {e.logical_date for e in entries} == {date(2016, 1, 1)}
    assert sorted(e.state for e in entries) == [runlog.FAILED, runlog.RUNNING]
    tasks = tables.read_log(spark, lake.task_log, TASK_LOG_SCHEMA)
    assert runlog.failed_tasks(tasks).first()[0] == 1
    report = run_day(spark, lake, "2016-01-01", raise_on_expectation=False)
    assert [r.column_name for r in report.expectations if r.failures] == ["is_suspicious"]


def test_lost_rows_stop_the_run_before_anything_is_written(spark, lake, monkeypatch):
    def lose_one(bronze, valid, quarantine):
        validation.check_conservation(bronze, valid - 1, quarantine)

    class Checked:
        def __getattr__(self, name):
            return lose_one if name == "check_conservation" else getattr(validation, name)

    monkeypatch.setattr(run_plan, "validation", Checked())
    with pytest.raises(CountMismatch):
        load(spark, lake, "2016-01-01")
    assert not Path(lake.silver).exists()


def test_rows_lost_in_the_stage_stop_the_run(spark, lake, monkeypatch):
    stage = run_plan._stage

    def lossy(*args):
        staged, counts = stage(*args)
        return staged.filter("nameOrig <> 'C7'"), counts

    monkeypatch.setattr(run_plan, "_stage", lossy)
    with pytest.raises(CountMismatch):
        load(spark, lake, "2016-01-01")
    assert not Path(lake.silver).exists()


def test_scratch_folder_is_removed(spark, lake, monkeypatch, tmp_path):
    scratch = str(tmp_path / "scratch")
    monkeypatch.setattr(run_plan, "shared_folder", lambda spark, root=None: scratch)
    load(spark, lake, "2016-01-01")
    assert not Path(scratch).exists()


def test_all_days_without_a_gate(spark, lake):
    assert all_days() == (date(2016, 1, 1), date(2016, 1, 31))
    report = load_silver(spark, read_bronze(spark, lake.bronze), lake.silver)
    assert report.silver_rows == len(stored(spark, lake))
    assert {row.tx_date.day for row in stored(spark, lake)} == {1, 2, 3}


def test_run_log_aggregates(spark):
    runs = [(date(2016, 1, 1), "success"), (date(2016, 1, 1), "failed"), (date(2016, 1, 2), "running")]
    got = runlog.runs_by_day(spark.createDataFrame(runs, RUN_LOG_SCHEMA)).collect()
    assert {tuple(row) for row in got} == {(date(2016, 1, 1), 1, 1), (date(2016, 1, 2), 0, 0)}
    tasks = [("silver", 2.0, "success"), ("silver", 4.0, "failed"), ("gold", 1.0, "success")]
    log = spark.createDataFrame(tasks, TASK_LOG_SCHEMA)
    assert {tuple(row) for row in runlog.mean_duration(log).collect()} == {
        ("silver", 3.0),
        ("gold", 1.0),
    }
    assert runlog.failed_tasks(log).first()[0] == 1


def test_totals_of_empty_tables_are_zero(spark):
    rows = silver.to_silver(validation.label(bronze(spark)))
    from ledgermill.operators import gold

    metrics = metrics_plan.build_metrics(
        bronze(spark), rows, gold.undetected_fraud(rows), gold.hourly_summary(rows)
    )
    got = {r.metric: r.value for r in metrics_plan.flat(metrics).collect()}
    assert got.pop(metrics_plan.LAST_SUCCESS_GAUGE) > 0
    assert got == {name: float(name == "fraud_reconcile_match") for name in got}
    assert len(got) == 9


def test_message_source_options():
    required = ["--servers", "b:1", "--topic", "t", "--bronze-path", "p", "--checkpoint", "c"]
    plain = _message_options(_parser().parse_args(["ingest", *required]))
    assert plain == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
    }
    sized = ["ingest", *required, "--min-partitions", "64", "--max-offsets", "1000"]
    options = _message_options(_parser().parse_args(sized))
    assert (options["minPartitions"], options["maxOffsetsPerTrigger"]) == ("64", "1000")


def test_command_line(spark, lake, tmp_path, capsys):
    silver_path, gold_path = str(tmp_path / "s"), str(tmp_path / "g")
    one = ["silver", "--bronze-path", lake.bronze, "--silver-path", silver_path]
    assert main([*one, "--target-tx-date", "2016-01-01", "--launcher-option", "x"]) == 0
    assert "days=1" in capsys.readouterr().out
    assert [p.name for p in Path(silver_path).glob("tx_date=*")] == ["tx_date=2016-01-01"]
    assert main(one) == 0
    assert len(list(Path(silver_path).glob("tx_date=*"))) == 3
    assert main(["gold", "--silver-path", silver_path, "--gold-path", gold_path]) == 0
    assert read_gold_table(spark, gold_path, "hourly_summary").count() > 0
    ready = ["ready", "--bronze-path", lake.bronze, "--day"]
    assert main([*ready, "2016-01-02"]) == 0
    assert main([*ready, "2016-01-03"]) == 1
    assert main(["ready", "--bronze-path", str(tmp_path / "none"), "--day", "2016-01-01"]) == 1
    marker = str(tmp_path / "marker")
    tables.write_feed_marker(spark, marker)
    assert main([*ready, "2016-01-03", "--done-marker", marker]) == 0
    root = lake.bronze.removesuffix("/bronze")
    assert main(["run", "--root", root, "--start", "2016-01-01", "--end", "2016-01-02"]) == 0
