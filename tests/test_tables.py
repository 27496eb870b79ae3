from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import gold, silver, validation
from ledgermill.schema import METRICS_SCHEMA, RUN_LOG_SCHEMA, SILVER_SCHEMA
from ledgermill.session import drop_folder, path_exists, recommended_conf, shared_folder
from ledgermill.sources import tables
from tests.records import bronze, record


def build(spark, *records):
    return silver.dedup(silver.to_silver(validation.label(bronze(spark, *records))))


def days(path: str) -> list[str]:
    return sorted(p.name for p in Path(path).glob("tx_date=*"))


def test_only_written_days_are_replaced(spark, tmp_path):
    path = str(tmp_path / "silver")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    tables.write_silver(build(spark, record(), record(step="25")), path)
    tables.write_silver(build(spark, record(nameOrig="C2")), path, many_days=False)
    assert days(path) == ["tx_date=2016-01-01", "tx_date=2016-01-02"]
    got = {(r.tx_date.day, r.nameOrig) for r in tables.read_silver(spark, path).collect()}
    assert got == {(1, "C2"), (2, "C1")}


def test_writing_no_rows_leaves_the_old_day(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(build(spark, record()), path)
    tables.write_silver(build(spark, record()).limit(0), path)
    assert tables.read_silver(spark, path).count() == 1


def test_silver_round_trip_keeps_columns_and_rows(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = build(spark, record(), record(step="30", isFraud=None, nameOrig="C2"))
    tables.write_silver(rows, path)
    stored = tables.read_silver(spark, path)
    assert stored.schema == SILVER_SCHEMA
    assert set(stored.collect()) == set(rows.collect())


def test_no_silver_yet(spark, tmp_path):
    empty = tables.read_silver(spark, str(tmp_path / "none"))
    assert (empty.count(), empty.schema) == (0, SILVER_SCHEMA)


def test_quarantine_is_no_part_of_silver(spark, tmp_path):
    path = str(tmp_path / "silver")
    rejected = validation.label(bronze(spark, record(step="0"), record(amount=None, kafka_timestamp=None)))
    tables.write_silver(build(spark, record()), path)
    tables.write_quarantine(validation.to_quarantine(rejected), path)
    assert tables.read_silver(spark, path).count() == 1
    got = {(r.reject_reason, r.ingest_date) for r in tables.read_quarantine(spark, path).collect()}
    assert got == {("invalid_step", date(2026, 1, 1)), ("parse_error", None)}


def test_day_filter_prunes_silver_folders(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_silver(build(spark, *[record(step=str(s)) for s in (1, 25, 49)]), path)
    one = tables.read_silver(spark, path).filter(F.col("tx_date") == date(2016, 1, 2))
    assert one.count() == 1
    undetected = gold.undetected_fraud(tables.read_silver(spark, path))
    plan = undetected._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(is_suspicious), EqualTo(is_suspicious,true)]" in plan
    assert "kafka_timestamp:timestamp" not in plan.split("ReadSchema")[-1]


def test_hot_day_is_written_by_several_tasks(spark, session_conf, tmp_path):
    """A day larger than the advisory size becomes several files, small days stay whole."""
    session_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    session_conf("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    path = str(tmp_path / "silver")
    day = F.when(F.col("id") % 3 == 0, F.lit(date(2016, 1, 9))).otherwise(
        F.date_add(F.lit(date(2016, 1, 10)), (F.col("id") % 7).cast("int"))
    )
    known = {"row_id": F.sha2(F.col("id").cast("string"), 256), "tx_date": day}
    columns = [
        known.get(field.name, F.lit(None).cast(field.dataType)).alias(field.name)
        for field in SILVER_SCHEMA
    ]
    tables.write_silver(spark.range(20000, numPartitions=8).select(columns), path)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in Path(path).glob("tx_date=*")}
    assert files["tx_date=2016-01-09"] > 1
    assert tables.read_silver(spark, path).count() == 20000


def test_gold_is_rebuilt_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "gold")
    for rows in (build(spark, record(isFraud="1")), build(spark, record(isFraud="1", nameOrig="C7"))):
        tables.write_gold(gold.account_risk(rows), path, "account_risk")
    (row,) = tables.read_gold(spark, path, "account_risk").collect()
    assert row.account_id == "C7"


def test_a_failing_rebuild_leaves_the_old_gold(spark, tmp_path):
    path = str(tmp_path / "gold")
    tables.write_gold(spark.range(3), path, "t")
    with pytest.raises(Exception, match="(?i)stop here"):
        tables.write_gold(spark.range(5).select(F.raise_error(F.lit("stop here")).alias("id")), path, "t")
    assert tables.read_gold(spark, path, "t").count() == 3
    for n in (7, 8):
        tables.write_gold(spark.range(n), path, "t")
    assert tables.read_gold(spark, path, "t").count() == 8
    assert len(list((tmp_path / "gold" / "t").glob("version=*"))) == 2
    with pytest.raises(FileNotFoundError):
        tables.read_gold(spark, path, "none")


def test_no_quarantine_yet(spark, tmp_path):
    assert tables.read_quarantine(spark, str(tmp_path / "silver")).count() == 0


def test_publishing_replaces_only_the_named_metrics(spark, tmp_path):
    path = str(tmp_path / "metrics")
    first = [("a", {}, 1.0), ("b", {"day": "1"}, 2.0), ("b", {"day": "2"}, 3.0)]
    tables.write_metrics(spark.createDataFrame(first, METRICS_SCHEMA), path)
    tables.write_metrics(spark.createDataFrame([("b", {"day": "1"}, 9.0)], METRICS_SCHEMA), path)
    got = [(r.metric, r.labels, r.value) for r in tables.read_metrics(spark, path).collect()]
    assert sorted(got, key=str) == [("a", {}, 1.0), ("b", {"day": "1"}, 9.0)]


def test_feed_marker(spark, tmp_path):
    marker = str(tmp_path / "feed" / "done")
    assert not tables.feed_done(spark, marker)
    tables.write_feed_marker(spark, marker)
    assert tables.feed_done(spark, marker)


def test_log_is_empty_before_its_first_entry(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tables.read_log(spark, path, RUN_LOG_SCHEMA).count() == 0
    entry = spark.createDataFrame([(date(2016, 1, 1), "success")], RUN_LOG_SCHEMA)
    tables.append_log(entry, path)
    tables.append_log(entry, path)
    assert tables.read_log(spark, path, RUN_LOG_SCHEMA).count() == 2


def test_shared_folder_follows_the_setting(spark):
    folder = shared_folder(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert root is None or folder.startswith(root.rstrip("/") + "/")
    spark.range(1).write.parquet(folder)
    assert path_exists(spark, folder)
    drop_folder(spark, folder)
    assert not path_exists(spark, folder)


def test_shared_folder_on_a_cluster_needs_shared_storage(spark):
    class Cluster:
        """A session on a cluster, with or without a checkpoint folder."""

        def __init__(self, folder):
            self.conf = self
            self.sparkContext = self
            self.master, self.folder = "spark://host:7077", folder

        def get(self, key, default):
            return default

        def getCheckpointDir(self):
            return self.folder

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster(None))
    assert shared_folder(Cluster("s3a://b/cp/")).startswith("s3a://b/cp/ledgermill-")
    assert shared_folder(Cluster(None), "s3a://b/lake").startswith("s3a://b/lake/ledgermill-")


@pytest.mark.parametrize(("size", "partitions"), [(0, 200), (60 * 10**12, 223518)])
def test_partitions_grow_with_the_shuffle(size, partitions):
    conf = recommended_conf(size)
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(partitions)


def gauges(spark, **values):
    return spark.createDataFrame([(m, {"l": "x"}, v) for m, v in values.items()], METRICS_SCHEMA)


def shown(spark, path):
    return sorted((r.metric, r.value) for r in tables.read_metrics(spark, path).collect())


def test_publishers_at_the_same_time_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "metrics")
    with ThreadPoolExecutor(4) as publishers:
        list(publishers.map(lambda n: tables.write_metrics(gauges(spark, **{f"g{n}": float(n)}), path), range(8)))
    assert shown(spark, path) == [(f"g{n}", float(n)) for n in range(8)]


def test_the_newest_publish_of_a_gauge_wins_and_old_ones_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_PUBLISHES", 3)
    path = str(tmp_path / "metrics")
    assert shown(spark, path) == []
    for n in range(5):
        tables.write_metrics(gauges(spark, a=float(n), **{f"only{n}": 1.0}), path)
    assert shown(spark, path) == [("a", 4.0), *[(f"only{n}", 1.0) for n in range(5)]]
    assert len(list(Path(path).glob("publish=*"))) <= 3


def test_a_publish_during_a_merge_stays_newer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "metrics")
    for n in range(3):
        tables.write_metrics(gauges(spark, a=float(n)), path)
    write = tables._write_publish

    def meanwhile(*merged):
        monkeypatch.setattr(tables, "_write_publish", write)
        tables.write_metrics(gauges(spark, a=9.0), path)
        write(*merged)

    monkeypatch.setattr(tables, "_write_publish", meanwhile)
    tables.compact_metrics(spark, path)
    assert shown(spark, path) == [("a", 9.0)]


def test_an_unfinished_publish_is_not_read(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.write_metrics(gauges(spark, a=1.0), path)
    tables.write_metrics(gauges(spark, a=2.0), path)
    newest = sorted(Path(path).glob("publish=*"))[-1]
    (newest / "_SUCCESS").unlink()
    assert shown(spark, path) == [("a", 1.0)]
