"""The metrics mart: every published gauge as rows ``metric, labels, value``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import day_to_millis
from ledgermill.operators import kpis, partials, reconcile, runlog
from ledgermill.schema import STEP_EPOCH

# Gauge names, by what they are computed from.
TOTAL_GAUGES = {
    "fraud_undetected_total": "gold_rows",
    "fraud_suspicious_total": "suspicious_rows",
    "fraud_actual_total": "fraud_rows",
    "fraud_flagged_total": "flagged",
    "fraud_true_positive_total": "true_positive",
    "fraud_false_positive_total": "false_positive",
    "fraud_rule_precision": "rule_precision",
    "fraud_rule_recall": "rule_recall",
    "fraud_reconcile_match": "reconcile_match",
}
LAST_SUCCESS_GAUGE = "fraud_batch_last_success_timestamp_seconds"
DAY_GAUGES = {
    "fraud_by_date_rows": "silver_rows",
    "fraud_by_date_fraud": "fraud_rows",
    "fraud_by_date_bs_diff": "bs_diff",
    "fraud_by_date_sg_diff": "sg_diff",
}
HOUR_GAUGES = {"fraud_by_hour_tx": "tx_count", "fraud_by_hour_fraud": "fraud_count"}
TYPE_GAUGES = {"fraud_type_tx": "tx_count", "fraud_type_fraud": "fraud_count"}
RECEIVER_GAUGES = {"fraud_mule_recv_count": "recv_count"}
RUN_GAUGES = {"fraud_dagrun_success": "success_runs", "fraud_dagrun_failed": "failed_runs"}

DAY_LABEL, HOUR_LABEL, TYPE_LABEL, ACCOUNT_LABEL = "d_ms", "ts_ms", "type", "account"

# The one gauge that compares a day with Bronze.
BRONZE_GAUGE = "fraud_by_date_bs_diff"


def _cells(gauges: dict[str, str], labels: Column) -> Column:
    """Array of ``(metric, labels, value)`` read off the columns of one row."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                labels.alias("labels"),
                F.col(source).cast("double").alias("value"),
            )
            for name, source in gauges.items()
        ]
    )


def _label(name: str, value: Column) -> Column:
    return F.create_map(F.lit(name), value.cast("string"))


def _gauges(df: DataFrame, cells: Column) -> DataFrame:
    return df.select(F.inline(cells))


# Counts that the totals need beyond those of the reconciliation.
CARRIED = ["flagged", "true_positive", "false_positive"]


def _with_totals(days: DataFrame) -> DataFrame:
    """Counts of all layers per event day and, in the row with ``is_total = 1``, over all days."""
    counts = [name for name in days.columns if name != "tx_date"]
    # A day without counts keeps the total row there while the tables are still empty.
    no_day = days.sparkSession.range(1).select(
        F.lit(None).cast("date").alias("tx_date"), *[F.lit(0).alias(name) for name in counts]
    )
    return (
        days.unionByName(no_day)
        .rollup("tx_date")
        .agg(
            F.grouping("tx_date").alias("is_total"), *[F.sum(name).alias(name) for name in counts]
        )
        .withColumns(
            {
                "rule_precision": kpis.share("true_positive", "flagged"),
                "rule_recall": kpis.share("true_positive", "fraud_rows"),
                "reconcile_match": F.when(
                    F.col("gold_rows") == F.col("suspicious_rows"), 1.0
                ).otherwise(0.0),
                "now": F.unix_timestamp(),
            }
        )
    )


# What gauges are read off: counts by day, the hourly table, the top receivers, the run log.
PARTS = ("days", "activity", "receivers", "runs")


def build_metrics(
    bronze: DataFrame,
    silver: DataFrame,
    undetected: DataFrame,
    hourly: DataFrame,
    run_log: DataFrame | None = None,
    step_epoch: str = STEP_EPOCH,
    top_n: int = kpis.TOP_ACCOUNTS,
    parts: tuple[str, ...] = PARTS,
) -> DataFrame:
    """All gauges as one frame, from whole layers; ``parts`` leaves out what is not asked for.

    Bronze, Silver and ``undetected_fraud`` are each aggregated by day once; totals, rule quality
    and the day gauges are read off those at most 31 rows. Silver is read a second time only for
    the top receivers, where just its fraud rows leave the scan. Hour and type gauges come from
    one pass over the hourly Gold table.
    """
    days = reconcile.by_date(
        reconcile.bronze_valid_by_date(bronze, step_epoch),
        partials.counts(silver),
        reconcile.gold_by_date(undetected),
        carry=CARRIED,
    )
    return assemble(days, hourly, kpis.top_receivers(silver, top_n), run_log, parts)


def assemble(
    days: DataFrame,
    hourly: DataFrame,
    receivers: DataFrame,
    run_log: DataFrame | None = None,
    parts: tuple[str, ...] = PARTS,
) -> DataFrame:
    """All gauges from the counts of all layers by day, the hourly table and the top receivers."""
    no_labels = F.from_json(F.lit("{}"), "map<string,string>")
    layer_cells = F.when(
        F.col("is_total") == 1, _cells(TOTAL_GAUGES | {LAST_SUCCESS_GAUGE: "now"}, no_labels)
    ).when(
        F.col("silver_rows") > 0,
        _cells(DAY_GAUGES, _label(DAY_LABEL, day_to_millis("tx_date"))),
    )
    activity = hourly.groupingSets([["tx_hour"], ["type"]], "tx_hour", "type").agg(
        F.grouping("type").alias("is_hour"),
        F.sum("tx_count").alias("tx_count"),
        F.sum("fraud_count").alias("fraud_count"),
    )
    activity_cells = F.when(
        F.col("is_hour") == 1, _cells(HOUR_GAUGES, _label(HOUR_LABEL, F.unix_millis("tx_hour")))
    ).otherwise(_cells(TYPE_GAUGES, _label(TYPE_LABEL, F.col("type"))))

    found = {
        "days": _gauges(_with_totals(days), layer_cells),
        "activity": _gauges(activity, activity_cells),
        "receivers": _gauges(receivers, _cells(RECEIVER_GAUGES, _label(ACCOUNT_LABEL, F.col("nameDest")))),
    }
    if run_log is not None:
        run_cells = _cells(RUN_GAUGES, _label(DAY_LABEL, day_to_millis("logical_date")))
        found["runs"] = _gauges(runlog.runs_by_day(run_log), run_cells)
    return reduce(DataFrame.unionByName, [found[part] for part in parts if part in found])


def flat(metrics: DataFrame) -> DataFrame:
    """Metrics with their single label's value as a plain column, empty for unlabelled gauges."""
    label_value = F.coalesce(F.try_element_at(F.map_values("labels"), F.lit(1)), F.lit(""))
    return metrics.select("metric", label_value.alias("label_value"), "value")
