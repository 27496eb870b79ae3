from __future__ import annotations

import json

import pytest

from ledgermill.schema import PAYLOAD_FIELDS
from ledgermill.sources import publish as publish_files
from ledgermill.sources import raw
from ledgermill.sources.publish import delivered, publish


@pytest.fixture
def files(tmp_path, session_conf):
    """Three files of 40, 0 and 25 records, read in many splits."""
    session_conf("spark.sql.files.maxPartitionBytes", "300")
    session_conf("spark.sql.files.openCostInBytes", "0")
    folder = tmp_path / "raw"
    folder.mkdir()
    number = 0
    for name, count in (("a.csv", 40), ("b.csv", 0), ("c.csv", 25)):
        lines = [",".join(PAYLOAD_FIELDS)]
        for _ in range(count):
            lines.append(f"{number % 60 + 1},PAYMENT,{number}," + ",".join("x" * 8))
            number += 1
        (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder), str(tmp_path / "ledger")


class Topic:
    """Takes messages, and dies in the middle of the sends that it is told to."""

    def __init__(self, dies_at=()):
        self.sent, self.sends, self.dies_at = [], 0, dies_at

    def __call__(self, messages):
        numbers = sorted(int(json.loads(m.value)["amount"]) for m in messages.collect())
        self.sends += 1
        if self.sends in self.dies_at:
            self.sent.append(numbers[: len(numbers) // 2])
            raise OSError("broker lost")
        self.sent.append(numbers)

    def numbers(self):
        return [n for batch in self.sent for n in batch]


def test_a_second_publish_sends_only_what_is_new(spark, files, tmp_path):
    folder, ledger = files
    topic = Topic()
    assert publish(spark, folder, ledger, topic) == 65
    assert sorted(topic.numbers()) == list(range(65))
    assert publish(spark, folder, ledger, topic) == 0
    (tmp_path / "raw" / "d.csv").write_text(",".join(PAYLOAD_FIELDS) + "\n" + "1,DEBIT,99," + ",".join("x" * 8))
    assert publish(spark, folder, ledger, topic) == 1
    assert topic.sent[-1] == [99]


def test_limits_follow_on_without_gap_or_repeat(spark, files):
    folder, ledger = files
    topic = Topic()
    for wanted in (7, 30, 10, 100):
        publish(spark, folder, ledger, topic, limit=wanted)
    assert topic.sent == [list(range(7)), list(range(7, 37)), list(range(37, 47)), list(range(47, 65))]


@pytest.mark.parametrize("limit", [0, 50])
def test_a_publish_that_dies_goes_on_without_a_gap(spark, files, limit):
    folder, ledger = files
    topic = Topic(dies_at=(2,))
    with pytest.raises(OSError):
        publish(spark, folder, ledger, topic, limit=limit, step_records=1)
    assert set(delivered(spark, ledger).values()) == {40}
    publish(spark, folder, ledger, topic, limit=limit - 40 if limit else 0, step_records=1)
    assert set(topic.numbers()) == set(range(limit or 65))


def test_other_splits_do_not_matter(spark, files, session_conf):
    folder, ledger = files
    topic = Topic()
    publish(spark, folder, ledger, topic, limit=23)
    session_conf("spark.sql.files.maxPartitionBytes", "117")
    publish(spark, folder, ledger, topic)
    assert topic.numbers() == list(range(65))


def test_event_days(spark, files):
    folder, ledger = files
    topic = Topic()
    assert publish(spark, folder, ledger, topic, max_days=1) == 65
    assert topic.numbers() == [n for n in range(65) if n % 60 < 24]


@pytest.mark.parametrize("n", [1, 10, 41, 64, 65, 100])
def test_cap_beyond_what_the_driver_takes(spark, files, monkeypatch, n):
    """Partitions are counted in steps; the rows before the cut are the first of the files."""
    monkeypatch.setattr(raw, "HEAD_ROWS", 0)
    folder, _ = files
    rows = raw.read_raw_csv(spark, folder).repartition(1).sortWithinPartitions("amount").coalesce(1)
    assert raw._first_rows(rows, n).count() == min(n, 65)
    many = raw.read_raw_csv(spark, folder)
    assert many.rdd.getNumPartitions() > 4
    got = [r.amount for r in raw._first_rows(many, n).collect()]
    assert got == [r.amount for r in many.collect()][:n]


def test_a_small_cap_reads_the_first_splits_only(spark, files):
    folder, _ = files
    assert publish_files._files(spark, folder)[0].endswith("a.csv")
    seen = spark.sparkContext.accumulator(0)
    rows = raw.read_raw_csv(spark, folder)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    capped = raw.to_messages(rows.mapInArrow(count, rows.schema), limit=3)
    assert capped.count() == 3 and seen.value < 30
