from __future__ import annotations

import random

import pytest

from ledgermill.schema import PAYLOAD_FIELDS
from ledgermill.sources import multiline, raw

HEADER = ",".join(PAYLOAD_FIELDS)


def one_task(spark, path):
    """The same files as Spark reads them with one task a file."""
    options = raw.CSV_OPTIONS | {"multiLine": "true"}
    names = spark.read.options(**options).csv(path).columns
    rows = spark.read.schema(", ".join(f"`{n}` STRING" for n in names)).options(**options).csv(path)
    return rows.select(PAYLOAD_FIELDS).na.fill("")


def same(spark, path, normal=lambda text: text):
    def rows(df):
        return sorted(tuple(map(normal, row)) for row in df.collect())

    got = rows(raw.read_raw_csv(spark, path, multi_line=True))
    assert got == rows(one_task(spark, path))
    return got


def field(rng):
    text = "".join(rng.choice(['a', 'b', ' ', ',', '"', '\n', '\r\n', '\n\n', 'ü']) for _ in range(rng.randint(0, 12)))
    if rng.random() < 0.5:
        return '"' + text.replace('"', '""') + '"'
    plain = text.replace(",", "").replace("\n", "").replace("\r", "")
    return plain.lstrip('"') or "0"


def quoted_lines(rng, rows, end="\n"):
    return end.join([HEADER, *[",".join(field(rng) for _ in PAYLOAD_FIELDS) for _ in range(rows)]]) + end


@pytest.mark.parametrize("split", [64, 100, 1000, 10_000_000])
def test_one_file_in_many_splits(spark, tmp_path, session_conf, split):
    session_conf("spark.sql.files.maxPartitionBytes", str(split))
    session_conf("spark.sql.files.openCostInBytes", "0")
    (tmp_path / "a.csv").write_bytes(quoted_lines(random.Random(split), 300).encode())
    got = same(spark, str(tmp_path))
    assert any("\r\n" in v for row in got for v in row)
    if split <= 1000:
        assert multiline._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8


def test_several_files_line_ends_and_blank_lines(spark, tmp_path, session_conf):
    session_conf("spark.sql.files.maxPartitionBytes", "300")
    rng = random.Random(1)
    (tmp_path / "a.csv").write_bytes(quoted_lines(rng, 40, "\r\n").encode())
    (tmp_path / "b.csv").write_bytes(b"\n\n" + quoted_lines(rng, 40).encode() + b"\n\n")
    (tmp_path / "c.csv").write_bytes((HEADER + "\n").encode())
    (tmp_path / "d.csv").write_bytes(quoted_lines(rng, 30).rstrip("\n").encode())
    # In a file of CRLF lines Spark's own reader turns those inside quotes to LF; here they stay.
    same(spark, str(tmp_path), lambda text: text.replace("\r\n", "\n"))


def test_record_longer_than_many_splits(spark, tmp_path, session_conf):
    session_conf("spark.sql.files.maxPartitionBytes", "200")
    session_conf("spark.sql.files.openCostInBytes", "0")
    long = '"' + '\n"",x,\n""\r\n' * 300 + '"'
    rows = [HEADER, ",".join(["1"] * 10 + [long]), ",".join(["2"] * 11), ",".join([long] + ["3"] * 10), ",".join(["4"] * 11)]
    (tmp_path / "a.csv").write_bytes("\n".join(rows).encode())
    got = same(spark, str(tmp_path))
    assert len(got) == 4 and max(len(v) for row in got for v in row) > 2000


def test_field_that_is_never_closed(spark, tmp_path, session_conf):
    session_conf("spark.sql.files.maxPartitionBytes", "64")
    session_conf("spark.sql.files.openCostInBytes", "0")
    (tmp_path / "a.csv").write_text(HEADER + "\n" + ",".join("1" * 11) + "\n2,\"open\n3,4\n" + "5,6,7\n" * 30)
    got = raw.read_raw_csv(spark, str(tmp_path), multi_line=True).collect()
    assert len(got) == 2 and got[1].type.startswith("open\n3,4\n5,6,7")


def test_quotes_inside_a_plain_field_are_text(spark, tmp_path, session_conf):
    session_conf("spark.sql.files.maxPartitionBytes", "64")
    session_conf("spark.sql.files.openCostInBytes", "0")
    lines = [HEADER, *[f'{n},5" pipe,x"y"z,"a""b\n",' + ",".join("1" * 7) for n in range(60)]]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    got = raw.read_raw_csv(spark, str(tmp_path), multi_line=True).collect()
    assert len(got) == 60
    assert {(r.type, r.amount, r.nameOrig) for r in got} == {('5" pipe', 'x"y"z', 'a"b\n')}


def test_other_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n" + ",".join("1" * 11) + "\n")
    (tmp_path / "b.csv").write_text(",".join(reversed(PAYLOAD_FIELDS)) + "\n" + ",".join("1" * 11) + "\n")
    with pytest.raises(Exception, match="header"):
        raw.read_raw_csv(spark, str(tmp_path), multi_line=True).collect()


def test_many_splits_that_begin_inside_quotes_are_joined_without_broadcast(spark, tmp_path, session_conf, monkeypatch):
    monkeypatch.setattr(multiline, "BROADCAST_ROWS", 0)
    session_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    session_conf("spark.sql.files.maxPartitionBytes", "100")
    session_conf("spark.sql.files.openCostInBytes", "0")
    (tmp_path / "a.csv").write_bytes(quoted_lines(random.Random(4), 100).encode())
    same(spark, str(tmp_path))


@pytest.mark.parametrize("seed", range(20))
def test_state_of_a_line(seed):
    """Against a reading character by character."""
    rng = random.Random(seed)
    for inside in (False, True):
        line = "".join(rng.choice('",,a" ') for _ in range(rng.randint(0, 14)))
        quoted, at_start, i = inside, not inside, 0
        while i < len(line):
            c = line[i]
            if quoted and c == '"':
                if line[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    quoted = at_start = False
            elif not quoted:
                quoted = c == '"' and at_start
                at_start = c == ","
            i += 1
        assert multiline.ends_inside(line, inside) == quoted
