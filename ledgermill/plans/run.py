"""The daily run and the backfill over many days."""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions import event_date, int_prefix
from ledgermill.operators import gate, quality, reconcile, runlog, silver, validation
from ledgermill.plans import metrics as metrics_plan
from ledgermill.plans.bronze_days import read_bronze_days, update_bronze_days
from ledgermill.plans.gold_days import (
    expectations,
    read_day_table,
    read_gold_table,
    top_receivers,
    update_gold,
)
from ledgermill.schema import (
    FIRST_STEP,
    LAST_STEP,
    RUN_LOG_SCHEMA,
    STEP_EPOCH,
    TASK_LOG_SCHEMA,
    as_day,
)
from ledgermill.session import drop_folder, shared_folder
from ledgermill.sources import tables
from ledgermill.sources.bronze import read_bronze


@dataclass(frozen=True)
class Lake:
    """Where each layer lives."""

    bronze: str
    silver: str
    gold: str
    metrics: str
    run_log: str
    task_log: str
    # Bronze's own counts of each event day.
    bronze_days: str
    # Holds labelled records during a run, where the session names no shared storage.
    scratch: str

    @classmethod
    def below(cls, root: str) -> Lake:
        names = ["bronze", "silver", "gold", "metrics", "run_log", "task_log", "bronze_days", "scratch"]
        return cls(**{name: f"{root.rstrip('/')}/{name}" for name in names})


@dataclass
class RunReport:
    """What a run read, wrote and found."""

    ready: list[date] = field(default_factory=list)
    not_ready: list[date] = field(default_factory=list)
    # Ready days whose records were all rejected: their old partition, if any, stays in place.
    without_rows: list[date] = field(default_factory=list)
    bronze_rows: int = 0
    valid_rows: int = 0
    quarantine_rows: int = 0
    candidate_rows: int = 0
    silver_rows: int = 0
    suspicious_rows: int = 0
    # Result rows of the expectations, one per declaration.
    expectations: list[Row] = field(default_factory=list)

    @property
    def dedup_removed(self) -> int:
        return self.candidate_rows - self.silver_rows

    def summary(self) -> str:
        return (
            f"days={len(self.ready)} not_ready={len(self.not_ready)} "
            f"without_rows={len(self.without_rows)} bronze={self.bronze_rows} "
            f"valid={self.valid_rows} quarantine={self.quarantine_rows} "
            f"dedup_removed={self.dedup_removed} written={self.silver_rows} "
            f"suspicious={self.suspicious_rows}"
        )


MIRROR_DAY = "mirror_date"


def _span(start: str | date, end: str | date) -> list[date]:
    first, last = as_day(start), as_day(end)
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def _stage(
    spark: SparkSession,
    bronze: DataFrame,
    days: list[date],
    folder: str,
    step_epoch: str,
    strict: bool,
    with_mirror: bool = False,
) -> tuple[DataFrame, dict]:
    """Parse and label Bronze once; keep what this run can write, count everything.

    ``with_mirror`` also works out the independent check of each record, and keeps all that pass it.

    Rejected records and valid ones of the asked days go to a Parquet table in the shared folder.
    Silver and the quarantine are then written from its few columns, and a lost executor costs a
    re-read of that table, not of the JSON. Counts of *all* records are observed on the same pass,
    so they are known before anything is published; it has no shuffle, so that a repeated task
    cannot count twice.
    """
    labelled = validation.label(bronze, strict).withColumns(
        {
            "tx_date": event_date(int_prefix("step"), step_epoch),
            "arrival_date": gate.arrival_day(step_epoch),
        }
    )
    wanted = F.expr(validation.IS_REJECTED) | _within(days, F.col("tx_date"))
    if with_mirror:
        labelled = labelled.withColumn(MIRROR_DAY, reconcile.mirror_day(step_epoch))
        wanted = wanted | F.col(MIRROR_DAY).isNotNull()
    counts = Observation()
    observed = labelled.observe(
        counts,
        *validation.split_counts(),
        F.count_if(wanted).alias("staged_rows"),
        F.max("arrival_date").alias("last_arrival"),
    )
    path = f"{folder}/labelled"
    observed.filter(wanted).write.parquet(path)
    return spark.read.schema(labelled.schema).parquet(path), counts.get


def _within(days: list[date], day: Column) -> Column:
    return day.between(F.lit(days[0]), F.lit(days[-1]))


def _day_counts(staged: DataFrame, days: list[date]) -> dict[date | None, Row]:
    """Arrived, valid and rejected records of each asked day; all other days share one row."""
    day = F.coalesce("arrival_date", "tx_date")
    per_day = staged.groupBy(F.when(_within(days, day), day).alias("day")).agg(
        F.count("arrival_date").alias("arrived"),
        F.count_if(F.expr(validation.IS_VALID)).alias("valid"),
        F.count_if(F.expr(validation.IS_REJECTED)).alias("rejected"),
    )
    return {row.day: row for row in per_day.collect()}


def _choose_days(
    report: RunReport, days: list[date], seen: dict, last: date | None, feed_done: bool | None
) -> None:
    for day in days:
        arrived, valid = (seen[day].arrived, seen[day].valid) if day in seen else (0, 0)
        later = int(last is not None and last > day)
        if feed_done is not None and not gate.is_ready(arrived, later, feed_done):
            report.not_ready.append(day)
            continue
        report.ready.append(day)
        report.candidate_rows += valid
        if not valid:
            report.without_rows.append(day)


def _write_layers(
    staged: DataFrame, report: RunReport, silver_path: str, step_epoch: str
) -> None:
    """Write the ready days of Silver and all rejected records, counting in the writing stages."""
    row_count = F.count(F.lit(1)).alias("rows")
    suspicious = F.count_if("is_suspicious").alias("suspicious")
    kept, rejected = Observation(), Observation()
    rows = silver.to_silver(staged.filter(F.col("tx_date").isin(report.ready)), step_epoch)
    tables.write_silver(
        silver.dedup(rows),
        silver_path,
        many_days=len(report.ready) > 1,
        observe=(kept, row_count, suspicious),
    )
    report.silver_rows, report.suspicious_rows = kept.get["rows"], kept.get["suspicious"]
    tables.write_quarantine(
        validation.to_quarantine(staged), silver_path, observe=(rejected, row_count)
    )
    validation.check_conservation(report.quarantine_rows, 0, rejected.get["rows"])


def all_days(step_epoch: str = STEP_EPOCH) -> tuple[date, date]:
    """First and last event day that an accepted step can fall on."""
    first = datetime.fromisoformat(step_epoch)
    return first.date(), (first + timedelta(hours=LAST_STEP - FIRST_STEP)).date()


def load_silver(
    spark: SparkSession,
    bronze: DataFrame,
    silver_path: str,
    start: str | date | None = None,
    end: str | date | None = None,
    feed_done: bool | None = None,
    step_epoch: str = STEP_EPOCH,
    strict: bool = False,
    scratch_root: str | None = None,
    bronze_days: str | None = None,
) -> RunReport:
    """Bring the event days ``start`` to ``end`` from Bronze to Silver and the quarantine.

    Without ``end`` a single day, without ``start`` every day is written. If ``feed_done`` is given,
    days that have not fully arrived are left out. ``scratch_root`` is where the labelled records are
    put in between if the session names no shared storage. ``bronze_days`` is where Bronze's own counts
    of each day are kept (see ``bronze_days``); they come from the same pass over Bronze.
    """
    first, last = (start, end or start) if start else all_days(step_epoch)
    days = _span(first, last)
    report = RunReport()
    scratch = shared_folder(spark, scratch_root)
    try:
        staged, counts = _stage(spark, bronze, days, scratch, step_epoch, strict, bool(bronze_days))
        report.bronze_rows = counts["bronze_rows"]
        report.valid_rows = counts["valid_rows"]
        report.quarantine_rows = counts["quarantine_rows"]
        validation.check_conservation(
            report.bronze_rows, report.valid_rows, report.quarantine_rows
        )
        seen = _day_counts(staged, days)
        validation.check_conservation(
            counts["staged_rows"],
            sum(row.valid for row in seen.values()),
            sum(row.rejected for row in seen.values()),
        )
        _choose_days(report, days, seen, counts["last_arrival"], feed_done)
        if bronze_days:
            update_bronze_days(reconcile.bronze_keys(staged, MIRROR_DAY), bronze_days)
        if report.ready:
            _write_layers(staged, report, silver_path, step_epoch)
    finally:
        drop_folder(spark, scratch)
    return report


def run_days(
    spark: SparkSession,
    lake: Lake,
    start: str | date,
    end: str | date,
    feed_done: bool = False,
    step_epoch: str = STEP_EPOCH,
    strict: bool = False,
    raise_on_expectation: bool = True,
    ingest_from: str | date | None = None,
    ingest_to: str | date | None = None,
) -> RunReport:
    """Bring the event days ``start`` to ``end`` from Bronze to metrics, as one job per layer.

    Days that have not fully arrived are left out and reported. Silver is replaced for the ready
    days only; equal keys fall on equal days, so doing the days one by one or all together gives
    the same tables, and doing them again changes nothing. Any mismatch stops the run before the
    next layer is touched.

    ``ingest_from`` / ``ingest_to`` limit reading, and rewriting the quarantine, to the ingest days
    between; they have to cover every day on which records of the asked event days came in.

    Gold, expectations and metrics follow from what each day adds to them: the work of a run is that of
    its days, whatever came before (see ``gold_days`` and ``bronze_days``).
    """
    log = _RunLog(spark, lake)
    days = _span(start, end)
    log.note(days, runlog.RUNNING)
    try:
        bronze = read_bronze(spark, lake.bronze, ingest_from, ingest_to)
        with log.task("silver"):
            report = load_silver(
                spark, bronze, lake.silver, start, end, feed_done, step_epoch, strict, lake.scratch,
                lake.bronze_days,
            )
        days = report.ready
        if not days:
            return report
        with log.task("gold"):
            update_gold(spark, lake.silver, lake.gold)
        with log.task("expectations"):
            report.expectations = expectations(spark, lake.gold).collect()
            if raise_on_expectation:
                quality.check_expectations(report.expectations)
        with log.task("reconcile"):
            layers = _layers(spark, lake)
            row = layers.agg(
                F.coalesce(F.sum("gold_rows"), F.lit(0)).alias("gold_rows"),
                F.coalesce(F.sum("suspicious_rows"), F.lit(0)).alias("suspicious_rows"),
            ).first()
            reconcile.check_total(row.gold_rows, row.suspicious_rows)
        with log.task("metrics"):
            gauges = metrics_plan.assemble(
                layers,
                read_gold_table(spark, lake.gold, "hourly_summary"),
                top_receivers(spark, lake.gold),
                tables.read_log(spark, lake.run_log, RUN_LOG_SCHEMA),
            )
            tables.write_metrics(gauges, lake.metrics)
        log.note(days, runlog.SUCCESS)
    except Exception:
        log.note(days, runlog.FAILED)
        raise
    finally:
        log.flush()
    return report


def _layers(spark: SparkSession, lake: Lake) -> DataFrame:
    """Counts of all layers by event day."""
    return reconcile.by_date(
        read_bronze_days(spark, lake.bronze_days),
        read_day_table(spark, lake.gold, "day_counts"),
        reconcile.gold_by_date(read_day_table(spark, lake.gold, "undetected_fraud")),
        carry=metrics_plan.CARRIED,
    )


def run_day(spark: SparkSession, lake: Lake, day: str | date, **options) -> RunReport:
    """``run_days`` for a single day."""
    return run_days(spark, lake, day, day, **options)


class _RunLog:
    """Collects task durations and the run's outcome, a handful of rows per run."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self._spark, self._lake = spark, lake
        self._tasks: list[tuple] = []

    @contextmanager
    def task(self, task_id: str):
        began, state = time.monotonic(), runlog.FAILED
        try:
            yield
            state = runlog.SUCCESS
        finally:
            self._tasks.append((task_id, time.monotonic() - began, state))

    def note(self, days: list[date], state: str) -> None:
        rows = self._spark.createDataFrame([(day, state) for day in days], RUN_LOG_SCHEMA)
        tables.append_log(rows.coalesce(1), self._lake.run_log)

    def flush(self) -> None:
        if self._tasks:
            rows = self._spark.createDataFrame(self._tasks, TASK_LOG_SCHEMA)
            tables.append_log(rows.coalesce(1), self._lake.task_log)
