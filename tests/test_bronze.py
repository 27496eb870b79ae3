from __future__ import annotations

import json
from datetime import date

import pytest

from ledgermill.operators import validation
from ledgermill.schema import PAYLOAD_FIELDS
from ledgermill.sources import raw
from ledgermill.sources.bronze import read_bronze, write_bronze
from tests.records import VALID, bronze, record


def test_csv_keeps_text_and_empty_fields(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        ",".join(PAYLOAD_FIELDS)
        + "\n1,PAYMENT,007.10,C1,,1,M1,\"\",2,0,0\n2,DEBIT,5\n"
    )
    first, short = raw.read_raw_csv(spark, str(tmp_path)).orderBy("step").collect()
    assert (first.amount, first.oldbalanceOrg, first.oldbalanceDest) == ("007.10", "", "")
    assert (short.amount, short.nameOrig) == ("5", "")


def test_csv_goes_by_header_names(spark, tmp_path):
    names = ["note", *reversed(PAYLOAD_FIELDS)]
    row = ["x", "0", "1", "5", "4", "M1", "3", "2", '"C""1,"', "9.5", "PAYMENT", "7"]
    (tmp_path / "raw.csv").write_text(",".join(names) + "\n" + ",".join(row) + "\n")
    (got,) = raw.read_raw_csv(spark, str(tmp_path)).collect()
    assert (got.step, got.type, got.amount, got.nameOrig) == ("7", "PAYMENT", "9.5", 'C"1,')
    (other,) = raw.read_raw_csv(spark, str(tmp_path), multi_line=True).collect()
    assert other == got


def test_csv_without_a_field_or_with_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("step,type\n1,PAYMENT\n")
    with pytest.raises(raw.MissingColumns, match="amount"):
        raw.read_raw_csv(spark, str(tmp_path))
    both = tmp_path / "both"
    both.mkdir()
    (both / "a.csv").write_text(",".join(PAYLOAD_FIELDS) + "\n" + ",".join("1" * 11) + "\n")
    (both / "b.csv").write_text(",".join(reversed(PAYLOAD_FIELDS)) + "\n" + ",".join("1" * 11) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_raw_csv(spark, str(both)).collect()


def test_limit_is_met_in_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(raw, "HEAD_ROWS", 0)
    rows = bronze(spark, *[record(nameOrig=f"C{n}") for n in range(50)]).repartition(7)
    for n in (1, 13, 50, 80):
        assert raw.to_messages(rows, limit=n).count() == min(n, 50)
    plan = raw.to_messages(rows, limit=13)._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan


def test_messages_are_keyed_json_with_nulls(spark):
    rows = bronze(spark, record(nameOrig="C9", amount=None, nameDest="Ł"))
    (message,) = raw.to_messages(rows.drop("kafka_timestamp")).collect()
    assert message.key == "C9"
    assert "Ł" in message.value
    assert json.loads(message.value) == {
        name: {"nameOrig": "C9", "amount": None, "nameDest": "Ł"}.get(name, VALID[name])
        for name in PAYLOAD_FIELDS
    }


def test_message_limit_and_first_days(spark):
    rows = bronze(spark, *[record(step=str(step)) for step in (1, 24, 25, 48, 49)])
    assert raw.to_messages(rows, limit=2).count() == 2
    assert raw.to_messages(rows).count() == 5
    assert raw.first_days(rows, 1).count() == 2
    assert raw.first_days(rows, 2).count() == 4
    assert raw.first_days(rows, 0).count() == 5


def test_delivery_options():
    options = raw.delivery_options("broker:1", "payments")
    assert options["kafka.acks"] == "all"
    assert options["kafka.enable.idempotence"] == "true"
    assert options["topic"] == "payments"


def test_round_trip_by_ingest_day(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = bronze(
        spark, record(), record(kafka_timestamp=0, amount=None), record(kafka_timestamp=None)
    )
    write_bronze(rows, path)
    landed = read_bronze(spark, path)
    assert {row.date for row in landed.collect()} == {date(2026, 1, 1), date(1970, 1, 1), None}
    assert set(landed.select(rows.columns).collect()) == set(rows.collect())


def test_ingest_window_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "bronze")
    day = 86400000
    rows = [record(kafka_timestamp=n * day) for n in range(4)] + [record(kafka_timestamp=None)]
    write_bronze(bronze(spark, *rows), path)
    some = read_bronze(spark, path, "1970-01-02", date(1970, 1, 3))
    assert {row.date for row in some.collect()} == {date(1970, 1, 2), date(1970, 1, 3), None}
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(date" in scan
    assert "Filter" not in scan.split("FileScan")[0]


def test_odd_json_lines(spark, tmp_path):
    folder = tmp_path / "bronze" / "date=2026-01-01"
    folder.mkdir(parents=True)
    lines = [
        '{"step": "1", "type": "PAY',
        '[{"step":"7"}]',
        '{"step":"8","type":{"a":1}}',
        '{"step":"9","amount":5.50}',
    ]
    (folder / "part.json").write_text("\n".join(lines) + "\n")
    rows = {row.step: row for row in read_bronze(spark, str(tmp_path / "bronze")).collect()}
    assert rows[None]._corrupt_record == lines[0]
    assert rows["7"].type is None
    assert rows["8"].type == '{"a":1}'
    assert rows["9"].amount == "5.50"


def test_broken_line_reaches_the_quarantine_as_it_was(spark, tmp_path):
    folder = tmp_path / "bronze" / "date=2026-01-01"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text('{"step": "1", "type\n')
    labelled = validation.label(read_bronze(spark, str(tmp_path / "bronze")))
    (row,) = validation.to_quarantine(labelled).collect()
    assert (row.value, row.reject_reason) == ('{"step": "1", "type', "parse_error")
