"""One query per operator, from the shared test tables to a result frame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions import row_id
from ledgermill.operators import (
    gate,
    gold,
    kpis,
    partials,
    quality,
    reconcile,
    runlog,
    silver,
    validation,
)
from ledgermill.plans import metrics as metrics_plan
from ledgermill.plans import panels, payment_store
from ledgermill.plans.bronze_days import read_bronze_days, update_bronze_days
from ledgermill.plans.gold_days import read_gold_table, top_receivers, update_gold
from ledgermill.plans.run import Lake, all_days, load_silver, run_days
from ledgermill.schema import PAYLOAD_FIELDS, SILVER_SCHEMA
from ledgermill.session import shared_folder
from ledgermill.sources import bronze as bronze_files
from ledgermill.sources import raw, tables
from ledgermill.sources.publish import publish
from ledgermill.streaming.arrivals import arrivals_stream, read_arrivals
from ledgermill.streaming.ingest import ROLL_RECORDS, ingest_stream
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]

ONE_DAY = "2016-01-05"
LAST_DAY = "2016-01-30"
FEED_DAYS = 3


def wall_time(column: str) -> Column:
    """UTC wall time without a zone, so that results do not depend on the session's zone."""
    return F.expr(f"timestampadd(SECOND, unix_seconds({column}), TIMESTAMP_NTZ'1970-01-01')")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.label(inputs.bronze(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dedup(silver.to_silver(_labelled(spark, sf_dir)))


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a run leaves it: written once, so that what follows reads columns of a table."""
    path = shared_folder(spark)
    tables.write_silver(_silver(spark, sf_dir), path)
    return tables.read_silver(spark, path)


def _gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return gold.GOLD_TABLES[name](_silver(spark, sf_dir))


def _silver_columns(rows: DataFrame) -> DataFrame:
    shown = {
        "tx_timestamp": wall_time("tx_timestamp").alias("tx_timestamp"),
        "kafka_timestamp": F.unix_millis("kafka_timestamp").alias("kafka_timestamp"),
    }
    return rows.select(*[shown.get(name, F.col(name)) for name in SILVER_SCHEMA.fieldNames()])


# --- Sources and sinks --------------------------------------------------------------------------


def q_raw_csv(spark, sf_dir):
    """Fields in reverse order with a column too many, and quotes inside the account names."""
    path = shared_folder(spark)
    records = inputs.raw_records(spark, sf_dir).withColumn(
        "nameOrig", F.concat(F.lit('"'), "nameOrig", F.lit('"'))
    )
    shuffled = records.select(F.lit("x").alias("note"), *reversed(PAYLOAD_FIELDS))
    shuffled.write.option("header", True).option("escape", '"').csv(path)
    return raw.read_raw_csv(spark, path)


def q_raw_csv_multiline(spark, sf_dir):
    """Account names with line breaks, quotes and commas inside quotes, each file read by many tasks."""
    path = shared_folder(spark)
    broken = F.concat(F.lit('"'), "nameOrig", F.lit('\n,"\n'), "type")
    records = inputs.raw_records(spark, sf_dir).withColumn("nameOrig", broken)
    records.select(PAYLOAD_FIELDS).write.option("header", True).option("escape", '"').csv(path)
    return raw.read_raw_csv(spark, path, multi_line=True)


def q_messages(spark, sf_dir):
    return raw.to_messages(inputs.raw_records(spark, sf_dir))


def q_publish_resume(spark, sf_dir):
    """Messages as two capped publishes and a last one without a cap deliver them, by the ledger."""
    folder = shared_folder(spark)
    inputs.raw_records(spark, sf_dir).write.option("header", True).option("escape", '"').csv(f"{folder}/raw")
    for limit in (10, 700, 0):
        publish(
            spark, f"{folder}/raw", f"{folder}/ledger",
            lambda messages: messages.write.mode("append").parquet(f"{folder}/topic"), limit,
        )
    return spark.read.schema("key string, value string").parquet(f"{folder}/topic")


def q_first_days(spark, sf_dir):
    return raw.first_days(inputs.raw_records(spark, sf_dir), FEED_DAYS).select(PAYLOAD_FIELDS)


def _stream(spark, sf_dir, folder):
    """The messages as a stream over files, since no broker is at hand."""
    inputs.messages(spark, sf_dir).write.parquet(f"{folder}/messages")
    schema = "key string, value string, timestamp timestamp"
    return spark.readStream.schema(schema).parquet(f"{folder}/messages")


def q_stream_ingest(spark, sf_dir):
    """Messages landed by the batch-numbered sink, files rolled at the default size."""
    folder = shared_folder(spark)
    ingest_stream(
        _stream(spark, sf_dir, folder), f"{folder}/bronze", f"{folder}/checkpoint", available_now=True
    ).awaitTermination()
    landed = bronze_files.read_bronze(spark, f"{folder}/bronze")
    return landed.select(*PAYLOAD_FIELDS, "kafka_timestamp", "date")


def q_stream_roll(spark, sf_dir):
    """Rows of each ingest day, and whether a file holds more than the default roll or is empty."""
    folder = shared_folder(spark)
    ingest_stream(
        _stream(spark, sf_dir, folder), f"{folder}/bronze", f"{folder}/checkpoint", available_now=True
    ).awaitTermination()
    landed = bronze_files.read_bronze(spark, f"{folder}/bronze")
    files = landed.groupBy("date", F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy("date").agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > ROLL_RECORDS).alias("over_full")
    )


def q_bronze_scan(spark, sf_dir):
    path = shared_folder(spark)
    bronze_files.write_bronze(inputs.bronze(spark, sf_dir), path)
    landed = bronze_files.read_bronze(spark, path)
    return landed.select(*PAYLOAD_FIELDS, "kafka_timestamp", "date")


def q_silver_by_type(spark, sf_dir):
    path = shared_folder(spark)
    tables.write_silver(_silver(spark, sf_dir), path)
    tables.write_quarantine(validation.to_quarantine(_labelled(spark, sf_dir)), path)
    return (
        tables.read_silver(spark, path)
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("tx_count"), F.sum("amount").alias("total_amount"))
    )


def q_quarantine_table(spark, sf_dir):
    path = shared_folder(spark)
    tables.write_quarantine(validation.to_quarantine(_labelled(spark, sf_dir)), path)
    return (
        tables.read_quarantine(spark, path)
        .groupBy("ingest_date", "reject_reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def q_gold_table(spark, sf_dir):
    path = shared_folder(spark)
    tables.write_gold(_gold(spark, sf_dir, "account_risk"), path, "account_risk")
    stored = gold.sorted_accounts(tables.read_gold(spark, path, "account_risk"))
    return stored.withColumn("last_tx_at", wall_time("last_tx_at"))


def q_metrics_table(spark, sf_dir):
    path = shared_folder(spark)
    tables.write_metrics(_metrics(spark, sf_dir), path)
    return _comparable(tables.read_metrics(spark, path))


# --- Projections and filters --------------------------------------------------------------------


def q_reject_reasons(spark, sf_dir):
    reason = F.coalesce("reject_reason", F.lit("valid")).alias("reason")
    return _labelled(spark, sf_dir).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def q_valid(spark, sf_dir):
    rows = validation.valid_rows(_labelled(spark, sf_dir))
    return rows.select(*PAYLOAD_FIELDS, "kafka_timestamp")


def q_quarantine(spark, sf_dir):
    return (
        validation.to_quarantine(_labelled(spark, sf_dir))
        .withColumn("kafka_timestamp", F.unix_millis("kafka_timestamp"))
        .drop("value")
    )


def q_quarantine_payload(spark, sf_dir):
    return validation.to_quarantine(_labelled(spark, sf_dir)).select("value", "reject_reason")


def q_silver(spark, sf_dir):
    return _silver_columns(_silver(spark, sf_dir))


def q_silver_day(spark, sf_dir):
    one_day = silver.event_days(silver.to_silver(_labelled(spark, sf_dir)), ONE_DAY)
    return _silver_columns(silver.dedup(one_day))


def q_dedup(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        "row_id", "tx_date", "isFraud", F.unix_millis("kafka_timestamp").alias("first_seen_ms")
    )


def q_row_id(spark, sf_dir):
    rows = validation.valid_rows(_labelled(spark, sf_dir))
    return rows.groupBy(row_id().alias("row_id")).agg(F.count(F.lit(1)).alias("copies"))


def q_undetected_fraud(spark, sf_dir):
    rows = _gold(spark, sf_dir, "undetected_fraud")
    return rows.withColumn("tx_timestamp", wall_time("tx_timestamp"))


# --- Aggregates ---------------------------------------------------------------------------------


def q_hourly_summary(spark, sf_dir):
    rows = gold.sorted_hourly(_gold(spark, sf_dir, "hourly_summary"))
    return rows.withColumn("tx_hour", wall_time("tx_hour"))


def q_account_risk(spark, sf_dir):
    """From the daily sums of accounts, as a run keeps them: Silver is worked out once."""
    days = partials.accounts(_silver(spark, sf_dir))
    rows = gold.sorted_accounts(partials.account_risk(days))
    return rows.withColumn("last_tx_at", wall_time("last_tx_at"))


def q_silver_by_date(spark, sf_dir):
    return reconcile.silver_by_date(_silver(spark, sf_dir))


def q_gold_by_date(spark, sf_dir):
    return reconcile.gold_by_date(_gold(spark, sf_dir, "undetected_fraud"))


def q_bronze_valid_by_date(spark, sf_dir):
    return reconcile.bronze_valid_by_date(inputs.bronze(spark, sf_dir))


def q_by_hour(spark, sf_dir):
    rows = kpis.by_hour(_gold(spark, sf_dir, "hourly_summary"))
    return rows.withColumn("tx_hour", wall_time("tx_hour"))


def q_by_type(spark, sf_dir):
    return kpis.by_type(_gold(spark, sf_dir, "hourly_summary"))


def q_confusion(spark, sf_dir):
    return kpis.confusion(_silver(spark, sf_dir))


def q_rule_quality(spark, sf_dir):
    return kpis.rule_quality(kpis.confusion(_silver(spark, sf_dir)))


def q_conservation(spark, sf_dir):
    return validation.conservation(_labelled(spark, sf_dir))


def q_run_summary(spark, sf_dir):
    return silver.run_summary(_labelled(spark, sf_dir))


def q_mule_top_n(spark, sf_dir):
    return kpis.top_receivers(_silver(spark, sf_dir))


def q_total_rows(spark, sf_dir):
    return reconcile.total_rows(reconcile.silver_by_date(_silver(spark, sf_dir)))


def q_undetected_total(spark, sf_dir):
    return kpis.undetected_total(_gold(spark, sf_dir, "undetected_fraud"))


# --- Reconciliation and expectations ------------------------------------------------------------


def _reconciled_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stored_silver(spark, sf_dir)
    return reconcile.by_date(
        reconcile.bronze_valid_by_date(inputs.bronze(spark, sf_dir)),
        reconcile.silver_by_date(rows),
        reconcile.gold_by_date(gold.undetected_fraud(rows)),
    )


def q_reconcile_by_date(spark, sf_dir):
    return _reconciled_days(spark, sf_dir)


def q_reconcile_worst(spark, sf_dir):
    return reconcile.worst(_reconciled_days(spark, sf_dir))


def q_reconcile_total(spark, sf_dir):
    rows = _stored_silver(spark, sf_dir)
    return reconcile.total(rows, gold.undetected_fraud(rows))


def _expectations(spark: SparkSession, sf_dir: str, check: str) -> DataFrame:
    rows = _stored_silver(spark, sf_dir)
    checked = [e for e in quality.EXPECTATIONS if e.check == check]
    built = {"silver": rows} | {name: build(rows) for name, build in gold.GOLD_TABLES.items()}
    needed = {name: df for name, df in built.items() if name in {e.table for e in checked}}
    return quality.evaluate(needed, checked)


def q_expect_not_null(spark, sf_dir):
    return _expectations(spark, sf_dir, "not_null")


def q_expect_unique(spark, sf_dir):
    return _expectations(spark, sf_dir, "unique")


def q_expect_values(spark, sf_dir):
    return _expectations(spark, sf_dir, "accepted_values")


# --- Completeness and incremental runs ----------------------------------------------------------


def q_day_ready(spark, sf_dir):
    return gate.day_ready(inputs.bronze(spark, sf_dir), LAST_DAY)


def q_day_ready_any_step(spark, sf_dir):
    return gate.day_ready(inputs.bronze(spark, sf_dir), LAST_DAY, validate_step=False)


def q_day_ready_done(spark, sf_dir):
    """The feed's marker is written, found again, and closes the last day."""
    marker = f"{shared_folder(spark)}/done"
    tables.write_feed_marker(spark, marker)
    return gate.day_ready(
        inputs.bronze(spark, sf_dir), LAST_DAY, tables.feed_done(spark, marker)
    )


def q_ready_days(spark, sf_dir):
    return gate.ready_days(inputs.bronze(spark, sf_dir))


def q_stream_ready_days(spark, sf_dir):
    """The gate on the counts that a stream keeps, without reading Bronze."""
    folder = shared_folder(spark)
    arrivals_stream(
        _stream(spark, sf_dir, folder), f"{folder}/arrivals", f"{folder}/checkpoint", available_now=True
    ).awaitTermination()
    return gate.ready_days_from(read_arrivals(spark, f"{folder}/arrivals"))


def q_run_days(spark, sf_dir):
    folder = shared_folder(spark)
    lake = Lake.below(folder)
    bronze_files.write_bronze(inputs.bronze(spark, sf_dir), lake.bronze)
    run_days(spark, lake, *all_days(), feed_done=True, raise_on_expectation=False)
    return _silver_columns(tables.read_silver(spark, lake.silver))


def q_run_metrics(spark, sf_dir):
    """The gauges that a first run publishes, on its own log."""
    lake = Lake.below(shared_folder(spark))
    bronze_files.write_bronze(inputs.bronze(spark, sf_dir), lake.bronze)
    run_days(spark, lake, *all_days(), feed_done=True, raise_on_expectation=False)
    return _comparable(tables.read_metrics(spark, lake.metrics))


def _ingest_days(spark, path):
    """By event day the first and last ingest day of its records, at most one row a day."""
    landed = bronze_files.read_bronze(spark, path)
    days = landed.groupBy(gate.arrival_day().alias("day")).agg(
        F.min("date").alias("first"), F.max("date").alias("last")
    )
    return {r.day: (r.first, r.last) for r in days.collect()}


def q_run_day_by_day(spark, sf_dir):
    """Every event day in a load of its own, the last first, each reading the ingest days of its records."""
    lake = Lake.below(shared_folder(spark))
    bronze_files.write_bronze(inputs.bronze(spark, sf_dir), lake.bronze)
    windows = _ingest_days(spark, lake.bronze)
    first, last = all_days()
    for n in reversed(range((last - first).days + 1)):
        day = first + timedelta(days=n)
        arrived = bronze_files.read_bronze(spark, lake.bronze, *windows.get(day, (None, None)))
        load_silver(spark, arrived, lake.silver, day, feed_done=True)
    return _silver_columns(tables.read_silver(spark, lake.silver))


def _payment_store(spark, sf_dir):
    """The bucketed store after two batches that hold the deliveries of even and of odd minutes.

    A redelivery comes a minute later, so it is in the other batch than the first delivery. The second
    batch is taken in twice.
    """
    path = shared_folder(spark)
    labelled = _labelled(spark, sf_dir)
    minute = F.coalesce(F.floor(F.col("kafka_timestamp") / 60_000) % 2, F.lit(0))
    for part in (0, 1, 1):
        payment_store.take_in_bronze(labelled.filter(minute == part), path)
    return path


def q_store_payments(spark, sf_dir):
    """One row per payment over all batches, read from its buckets without an exchange."""
    return _silver_columns(payment_store.read_payments(spark, _payment_store(spark, sf_dir)))


def q_store_repeated(spark, sf_dir):
    """Row keys that came in more than one batch, each batch without copies of its own."""
    path = shared_folder(spark)
    labelled = _labelled(spark, sf_dir)
    minute = F.coalesce(F.floor(F.col("kafka_timestamp") / 60_000) % 2, F.lit(0))
    for part in (1, 0):
        payment_store.take_in_bronze(labelled.filter(minute == part), path)
    return payment_store.repeated_keys(spark, path).select("column_name", "failures", "failed_rows")


def q_store_merged(spark, sf_dir):
    """Rows of each day once the files of its batches are merged, copies gone."""
    path = _payment_store(spark, sf_dir)
    first, last = all_days()
    payment_store.merge_batches(spark, path, [first + timedelta(days=n) for n in range((last - first).days + 1)])
    return payment_store.read_batches(spark, path).groupBy("tx_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total_amount")
    )


def _reloaded_gold(spark, sf_dir):
    """Gold brought up to date after each load: half of the records, then all, some days at a time."""
    folder = shared_folder(spark)
    labelled = _labelled(spark, sf_dir)
    half = labelled.filter(F.pmod(F.xxhash64("nameOrig", "step", "amount"), F.lit(2)) == 0)
    loads = [silver.to_silver(half)] + [
        silver.to_silver(labelled).filter(F.dayofmonth("tx_date") % 3 == part) for part in (1, 0, 2)
    ]
    for rows in loads:
        tables.write_silver(silver.dedup(rows), f"{folder}/silver")
        update_gold(spark, f"{folder}/silver", f"{folder}/gold")
    return f"{folder}/gold"


def q_gold_by_day_accounts(spark, sf_dir):
    """Account risk after days were replaced: only touched accounts worked out again."""
    risk = read_gold_table(spark, _reloaded_gold(spark, sf_dir), "account_risk")
    return gold.sorted_accounts(risk).withColumn("last_tx_at", wall_time("last_tx_at"))


def q_gold_by_day_hours(spark, sf_dir):
    hours = read_gold_table(spark, _reloaded_gold(spark, sf_dir), "hourly_summary")
    return gold.sorted_hourly(hours).withColumn("tx_hour", wall_time("tx_hour"))


def q_gold_by_day_receivers(spark, sf_dir):
    """Top receivers from the heads of the days and the counts that can matter."""
    return top_receivers(spark, _reloaded_gold(spark, sf_dir))


def q_bronze_days(spark, sf_dir):
    """Bronze's own counts, kept as ingest days come in one after the other, each payment counted once."""
    path = shared_folder(spark)
    marked = inputs.bronze(spark, sf_dir).withColumn("mirror", reconcile.mirror_day())
    # The test records come in within hours, so their ingest days are spread out here.
    spread = marked.withColumn(
        "kafka_timestamp", F.col("kafka_timestamp") + F.pmod("kafka_timestamp", F.lit(7)) * 86_400_000
    )
    for part in range(3):
        day = F.coalesce(F.floor(F.col("kafka_timestamp") / 86_400_000), F.lit(0))
        keys = reconcile.bronze_keys(spread.filter(F.pmod(day, F.lit(3)) == part), "mirror")
        update_bronze_days(keys, path)
    return read_bronze_days(spark, path)


# --- Metrics and run log ------------------------------------------------------------------------


def _metrics(spark: SparkSession, sf_dir: str, parts=metrics_plan.PARTS) -> DataFrame:
    rows = _stored_silver(spark, sf_dir)
    return metrics_plan.build_metrics(
        inputs.bronze(spark, sf_dir),
        rows,
        gold.undetected_fraud(rows),
        gold.hourly_summary(rows),
        inputs.run_log(spark, sf_dir),
        parts=parts,
    )


def _comparable(metrics: DataFrame) -> DataFrame:
    """Flat metrics without the one gauge that holds the current time."""
    return metrics_plan.flat(metrics).filter(F.col("metric") != metrics_plan.LAST_SUCCESS_GAUGE)


def q_metrics(spark, sf_dir):
    return _comparable(_metrics(spark, sf_dir))


def q_panel_total_rows(spark, sf_dir):
    return panels.total_rows(_metrics(spark, sf_dir, ("days",)))


def q_panel_top_receivers(spark, sf_dir):
    return panels.top_receivers(_metrics(spark, sf_dir, ("receivers",)))


def q_panel_runs(spark, sf_dir):
    return panels.runs_by_day(_metrics(spark, sf_dir, ("runs",)))


def q_panel_last_success(spark, sf_dir):
    """Whether the published time of the last run is that of this query, give or take a day."""
    last = panels.last_success_millis(_metrics(spark, sf_dir, ("days",)))
    age = F.unix_millis(F.current_timestamp()) - F.col("last_success_ms")
    return last.select(age.between(-86_400_000, 86_400_000).alias("is_now"))


def q_runs_by_day(spark, sf_dir):
    return runlog.runs_by_day(inputs.run_log(spark, sf_dir))


def q_task_duration(spark, sf_dir):
    means = runlog.mean_duration(inputs.task_log(spark, sf_dir))
    return means.withColumn("mean_duration_s", F.round("mean_duration_s", 6))


def q_failed_tasks(spark, sf_dir):
    return runlog.failed_tasks(inputs.task_log(spark, sf_dir))


QUERIES: dict[str, Query] = {
    name: query for name, query in list(globals().items()) if name.startswith("q_")
}
