"""Gold kept up to date by event day.

What a day adds to Gold is kept by day, so bringing one day up to date reads one day of Silver and replaces
what the day added before. ``undetected_fraud`` and ``hourly_summary`` are such tables themselves.
``account_risk`` adds up an account's days: only accounts that had payments on the days replaced, before
or after, and are or were in the table are worked out again; all others are taken over.

Which days have to be brought up to date is read off Silver's files: each day's names are recorded once all
that it adds is written. A day that was reloaded, removed, or left half done by a run that died has other
names than recorded and is done again. Accounts to be worked out again are written down before their days
are replaced and crossed off with the new ``account_risk``, so a run that dies in between loses none.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.operators import gold, kpis, partials, quality
from ledgermill.operators.quality import EXPECTATIONS
from ledgermill.schema import SILVER_SCHEMA
from ledgermill.session import drop_folder, path_exists
from ledgermill.sources import tables

DONE_SCHEMA = "tx_date DATE, files STRING"
DONE_FIELDS = T.StructType([T.StructField("tx_date", T.DateType()), T.StructField("files", T.StringType())])
TOUCHED_SCHEMA = T.StructType([T.StructField("account_id", T.StringType())])
# Results of expectations on the days of a table. They add up over days, since equal keys fall on equal
# days; foreign values are named, as one may occur on several.
CHECK_SCHEMA = T.StructType(
    [
        T.StructField("tx_date", T.DateType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("failures", T.LongType()),
        T.StructField("failed_rows", T.LongType()),
    ]
)


def _folder(gold_path: str, name: str) -> str:
    return f"{gold_path.rstrip('/')}/{name}"


def day_schema(spark: SparkSession, name: str) -> T.StructType:
    """Columns of a table kept by day."""
    return partials.DAY_TABLES[name](spark.createDataFrame([], SILVER_SCHEMA)).schema


def read_day_table(
    spark: SparkSession, gold_path: str, name: str, days: Iterable[date] | None = None
) -> DataFrame:
    return tables.read_days(spark, _folder(gold_path, name), day_schema(spark, name), days)


def read_gold_table(spark: SparkSession, gold_path: str, name: str) -> DataFrame:
    """One of the published Gold tables."""
    if name == "account_risk":
        return tables.read_gold(spark, gold_path, name)
    rows = read_day_table(spark, gold_path, name)
    return rows.drop("tx_date") if name == "hourly_summary" else rows


def changed_days(spark: SparkSession, silver_path: str, gold_path: str) -> dict[date, str | None]:
    """Days whose Silver is other than Gold has taken in, with Silver's files now, None where it is gone."""
    now = tables.files_by_day(spark, silver_path)
    known = {}
    newest = tables.newest_version(spark, _folder(gold_path, "days_done"))
    if newest:
        known = {row.tx_date: row.files for row in spark.read.schema(DONE_SCHEMA).parquet(newest).collect()}
    return {day: now.get(day) for day in sorted(now.keys() | known.keys()) if now.get(day) != known.get(day)}


def update_gold(
    spark: SparkSession, silver_path: str, gold_path: str, everything: bool = False
) -> list[date]:
    """Bring Gold up to Silver and return the days that were done.

    ``everything`` does all days, whatever is recorded.
    """
    changed = changed_days(spark, silver_path, gold_path)
    now = tables.files_by_day(spark, silver_path)
    if everything:
        changed = {day: now.get(day) for day in now.keys() | changed.keys()}
    touched_path = _folder(gold_path, "account_touched")
    built = tables.newest_version(spark, _folder(gold_path, "account_risk"))
    days = sorted(changed)
    if not days and built and not path_exists(spark, touched_path):
        return []
    silver = tables.read_days(spark, silver_path, SILVER_SCHEMA, days)
    if built:
        _note_touched(read_day_table(spark, gold_path, "account_days", days), touched_path)

    def replace(name: str) -> None:
        rows = partials.DAY_TABLES[name](silver)
        tables.replace_days(rows, _folder(gold_path, name), days, partials.DAY_ORDER.get(name, ()))

    # The tables do not depend on each other; small ones would leave most of the cluster idle.
    with ThreadPoolExecutor(len(partials.DAY_TABLES)) as writers:
        list(writers.map(replace, partials.DAY_TABLES))
    tables.replace_days(_checked(spark, silver, gold_path, days), _folder(gold_path, "checks"), days)
    if built and not everything:
        _note_touched(read_day_table(spark, gold_path, "account_days", days), touched_path)
        risk = _updated_risk(spark, gold_path, touched_path, days)
    else:
        risk = partials.account_risk(read_day_table(spark, gold_path, "account_days"))
    tables.write_gold(risk, gold_path, "account_risk")
    drop_folder(spark, touched_path)
    done = [(day, files) for day, files in now.items()]
    rows = spark.createDataFrame(done, DONE_FIELDS).coalesce(1)
    tables.append_version(rows, _folder(gold_path, "days_done"))
    return days


def build_gold(spark: SparkSession, silver_path: str, gold_path: str) -> None:
    """Rebuild all of Gold from the whole of Silver."""
    update_gold(spark, silver_path, gold_path, everything=True)


def _note_touched(days: DataFrame, path: str) -> None:
    days.select("account_id").distinct().write.mode("append").parquet(path)


def _updated_risk(
    spark: SparkSession, gold_path: str, touched_path: str, changed: list[date]
) -> DataFrame:
    """``account_risk`` with the touched accounts worked out again from all of their days."""
    before = tables.read_gold(spark, gold_path, "account_risk")
    days = read_day_table(spark, gold_path, "account_days")
    touched = spark.read.schema(TOUCHED_SCHEMA).parquet(touched_path).distinct()
    # Others that were touched have no fraud on any of their days.
    fraud_now = partials.involved(read_day_table(spark, gold_path, "account_days", changed))
    listed = before.select("account_id").unionByName(fraud_now).distinct()
    again = touched.join(listed, "account_id", "left_semi")
    others = before.join(again, "account_id", "left_anti")
    return others.unionByName(partials.account_risk(days.join(again, "account_id", "left_semi")))


def _checked(spark: SparkSession, silver: DataFrame, gold_path: str, days: list[date]) -> DataFrame:
    """Expectations on what the given days hold, one row each and day."""
    parts = []
    own = {"silver": silver} | {
        name: read_day_table(spark, gold_path, name, days) for name in ("undetected_fraud", "hourly_summary")
    }
    for name, rows in own.items():
        parts.append(quality.evaluate_by_day(rows, [e for e in EXPECTATIONS if e.table == name]))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select(CHECK_SCHEMA.fieldNames())


def expectations(spark: SparkSession, gold_path: str) -> DataFrame:
    """``quality.evaluate`` over the whole of Silver and Gold, from what is kept by day."""
    keys = ["table_name", "check_name", "column_name"]
    kept = tables.read_days(spark, _folder(gold_path, "checks"), CHECK_SCHEMA)
    by_value = kept.groupBy(*keys, "value").agg(
        F.when(F.col("value").isNull(), F.sum("failures")).otherwise(F.max("failures")).alias("failures"),
        F.sum("failed_rows").alias("failed_rows"),
    )
    totals = by_value.groupBy(*keys).agg(F.sum("failures").alias("failures"), F.sum("failed_rows").alias("failed_rows"))
    declared = spark.createDataFrame(
        [(e.table, e.check, e.column) for e in EXPECTATIONS if e.table != "account_risk"], keys
    )
    zero = [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in ("failures", "failed_rows")]
    by_day = declared.join(totals, keys, "left").select(*keys, *zero)
    risk = {"account_risk": read_gold_table(spark, gold_path, "account_risk")}
    return by_day.select(quality.RESULT_COLUMNS).unionByName(quality.evaluate(risk))


def top_receivers(spark: SparkSession, gold_path: str, n: int = kpis.TOP_ACCOUNTS) -> DataFrame:
    """``kpis.top_receivers`` over all days, from their heads and the counts that can matter.

    The n-th sum over the heads is what n receivers have for sure. Should heads be older than the counts,
    as in the middle of a run, the n-th row found falls short of it, and all counts are added up instead.
    At most n rows reach the driver.
    """
    counts = read_day_table(spark, gold_path, "receiver_days")
    n_days = len(tables.files_by_day(spark, _folder(gold_path, "receiver_days")))
    heads = read_day_table(spark, gold_path, "receiver_heads")
    sure = partials.nth_total(partials.top_receivers(heads, n), n)
    found = partials.top_by_threshold(counts, n_days, n, sure)
    rows = found.collect()
    if sure and (len(rows) < n or rows[-1].recv_count < sure):
        rows = partials.top_receivers(counts, n).collect()
    # One partition, as the rows are in order.
    return spark.createDataFrame(rows, found.schema).coalesce(1)


def published(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    return {name: read_gold_table(spark, gold_path, name) for name in gold.GOLD_TABLES}
