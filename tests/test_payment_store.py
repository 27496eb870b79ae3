from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgermill.__main__ import main
from ledgermill.operators import quality, silver, validation
from ledgermill.plans import payment_store as store
from ledgermill.schema import SILVER_SCHEMA
from ledgermill.sources import tables
from ledgermill.sources.bronze import write_bronze
from tests.records import bronze, record

FIRST = date(2016, 1, 1)
LATER = 60_000


@pytest.fixture(params=[(4, 4), (4, 8), (4, 2), (4, 3), (4, 6)], ids=str)
def numbers(request, session_conf):
    """Shuffle partitions and buckets: the same, a multiple, a part, and neither."""
    session_conf("spark.sql.shuffle.partitions", str(request.param[0]))
    return request.param


def labelled(spark, *records):
    return validation.label(bronze(spark, *records))


def batches():
    """Overlapping batches with copies inside and across, on several days."""
    one = [record(step=str(1 + 24 * (i % 3)), nameOrig=f"C{i}") for i in range(40)]
    again = [r | {"kafka_timestamp": r["kafka_timestamp"] + LATER} for r in one[:15]]
    earlier = [r | {"kafka_timestamp": r["kafka_timestamp"] - LATER, "isFraud": "1"} for r in one[10:20]]
    undated = [r | {"kafka_timestamp": None} for r in one[18:25]]
    return [one + again[:5], again + [record(nameOrig="new", step="80")], earlier + undated, earlier]


def as_set(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def fill(spark, path, buckets):
    for records in batches():
        store.take_in_bronze(labelled(spark, *records), path, buckets)


def test_batches_give_the_same_payments_as_one_dedup(spark, tmp_path, numbers):
    path = str(tmp_path / "store")
    fill(spark, path, numbers[1])
    everything = labelled(spark, *[r for records in batches() for r in records])
    full = silver.dedup(silver.to_silver(everything))
    kept = store.read_payments(spark, path)
    assert kept.schema.fieldNames() == SILVER_SCHEMA.fieldNames() and kept.dtypes == full.dtypes
    assert as_set(kept) == as_set(full)
    one_day = store.read_payments(spark, path, "2016-01-02")
    assert as_set(one_day) == as_set(silver.event_days(full, "2016-01-02"))
    seen = store.read_batches(spark, path)
    outcome = [tuple(r) for r in store.repeated_keys(spark, path).collect()]
    assert outcome == [tuple(r) for r in quality.unique(seen, "row_id").collect()]
    assert outcome[0][2] > 0


def test_neither_dedup_nor_uniqueness_has_an_exchange(spark, tmp_path, session_conf):
    session_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    path = str(tmp_path / "store")
    fill(spark, path, 4)
    kept = store.read_payments(spark, path)
    assert "Exchange" not in plan_of(kept) and "Bucketed: true" in plan_of(kept)
    assert "Exchange" in plan_of(silver.dedup(spark.read.parquet(f"{path}/rows")))
    checked = plan_of(store.repeated_keys(spark, path))
    assert "hashpartitioning" not in checked and "Bucketed: true" in checked
    day = plan_of(store.read_payments(spark, path, "2016-01-01"))
    assert "PartitionFilters: [isnotnull(tx_date" in day and "Exchange" not in day


def test_taking_in_shuffles_once_where_numbers_fit(spark, tmp_path, numbers):
    """Whole buckets in each task: no bucket of a day has more files than tasks for it."""
    tasks, buckets = numbers
    path = str(tmp_path / "store")
    rows = spark.range(3000).select(F.concat(F.lit("C"), "id").alias("nameOrig"))
    wide = labelled(spark, record()).drop("nameOrig").crossJoin(rows)
    store.take_in_bronze(wide, path, buckets)
    files = list(Path(path, "rows").glob("tx_date=*/part-*"))
    assert len(files) <= max(buckets, tasks if tasks % buckets == 0 else 0)
    assert store.read_payments(spark, path).count() == 3000


def test_merged_days_hold_one_file_a_bucket_and_no_copies(spark, tmp_path):
    path = str(tmp_path / "store")
    fill(spark, path, 4)
    before = as_set(store.read_payments(spark, path))
    other = sorted(p.name for p in Path(path, "rows", "tx_date=2016-01-03").glob("part-*"))
    store.merge_batches(spark, path, [FIRST, date(2016, 1, 2), date(2016, 1, 30)])
    assert spark.conf.get(store.OVERWRITE_MODE).upper() == "STATIC"
    for day in ("2016-01-01", "2016-01-02"):
        assert len(list(Path(path, "rows", f"tx_date={day}").glob("part-*"))) <= 4
        seen = store.read_batches(spark, path, day)
        assert seen.count() == seen.select("row_id").distinct().count()
    assert sorted(p.name for p in Path(path, "rows", "tx_date=2016-01-03").glob("part-*")) == other
    assert as_set(store.read_payments(spark, path)) == before


def test_a_new_session_and_days_of_another_writer(spark, tmp_path):
    """The folder is all that counts: a session that has never seen it, or has seen it before, reads it."""
    path = str(tmp_path / "store")
    fill(spark, path, 4)
    before = as_set(store.read_payments(spark, path))
    other = spark.newSession()
    for row in spark.catalog.listTables(pattern="payments_*"):
        spark.sql(f"DROP TABLE {row.name}")
    store.take_in_bronze(labelled(other, record(step="200", nameOrig="late")), path, 7)
    assert store.bucket_count(spark, path) == 4
    after = store.read_payments(spark, path)
    assert after.count() == len(before) + 1
    for row in spark.catalog.listTables(pattern="payments_*"):
        spark.sql(f"DROP TABLE {row.name}")
    assert store.read_payments(spark, path).count() == len(before) + 1


def test_a_redelivered_payment_loads_no_task(spark, tmp_path):
    """A third of all rows are one payment: one row a task leaves for its bucket."""
    path = str(tmp_path / "store")
    rows = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("C"), "id")).alias("nameOrig")
    )
    wide = labelled(spark, record()).drop("nameOrig").crossJoin(rows)
    plan = silver.dedup(silver.to_silver(wide))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    store.take_in_bronze(wide, path, 4)
    assert store.read_batches(spark, path).count() == 2001


def test_silver_from_the_store_by_command(spark, tmp_path, capsys):
    """Bronze is taken in by two windows; Silver of a day, then of all days, equals the dedup of Bronze."""
    bronze_path, path, silver_path = (str(tmp_path / name) for name in ("bronze", "store", "silver"))
    day = 86_400_000
    one, again, *_ = batches()
    records = one + [r | {"kafka_timestamp": r["kafka_timestamp"] + day} for r in again]
    write_bronze(bronze(spark, *records), bronze_path)
    command = ["store", "--store-path", path, "--buckets", "3"]
    assert main([*command, "--bronze-path", bronze_path, "--ingest-to", "2026-01-01"]) == 0
    assert main([*command, "--bronze-path", bronze_path, "--ingest-from", "2026-01-02"]) == 0
    assert capsys.readouterr().out.splitlines()[-1] == "buckets=3 in_several_batches=15"
    full = silver.dedup(silver.to_silver(labelled(spark, *records)))
    assert main([*command, "--silver-path", silver_path, "--target-tx-date", "2016-01-02"]) == 0
    assert as_set(tables.read_silver(spark, silver_path)) == as_set(silver.event_days(full, "2016-01-02"))
    merged = ["--merge-day", "2016-01-01", "--merge-day", "2016-01-02", "--merge-day", "2016-01-03"]
    assert main([*command, "--silver-path", silver_path, *merged]) == 0
    assert as_set(tables.read_silver(spark, silver_path)) == as_set(full)
    assert capsys.readouterr().out.splitlines()[-1] == "buckets=3 in_several_batches=0"


def test_no_batch_and_empty_batches(spark, tmp_path):
    path = str(tmp_path / "a store's")
    assert store.read_payments(spark, path).count() == 0
    assert store.repeated_keys(spark, path).first().failures == 0
    store.merge_batches(spark, path, [FIRST])
    store.take_in_bronze(labelled(spark, record()).limit(0), path, 4)
    assert store.read_payments(spark, path).count() == 0
    store.take_in_bronze(labelled(spark, record()), path)
    assert store.read_payments(spark, path).count() == 1
    store.merge_batches(spark, path, [])
    assert store.repeated_keys(spark, path).first().failures == 0
