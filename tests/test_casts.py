from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import int_prefix, to_money, to_number

TRUNCATED = {
    "1.": 1,
    ".5": 0,
    ".": 0,
    "-.5": 0,
    "1.99": 1,
    "\t7": 7,
    "+5": 5,
    " 12 ": 12,
    "-3.9": -3,
    "007": 7,
    "+.": 0,
    "+": None,
    "-": None,
    "1.5.2": None,
    "1.a": None,
    "1e3": None,
    "10d": None,
    "": None,
    " ": None,
    "2147483648": None,
    "2147483647.9": 2147483647,
    "2147483648.1": None,
    None: None,
}


def _column(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [row[0] for row in df.select(expression).collect()]


def test_int_prefix_of_known_texts(spark):
    assert _column(spark, list(TRUNCATED), int_prefix("v")) == list(TRUNCATED.values())


def test_int_prefix_equals_the_lenient_cast(spark, session_conf):
    """The lenient cast of a session without ANSI mode is the definition to meet."""
    rng = random.Random(7)
    texts = ["".join(rng.choices("019.+- \tae", k=rng.randint(0, 7))) for _ in range(3000)]
    session_conf("spark.sql.ansi.enabled", "false")
    lenient = _column(spark, texts, F.col("v").cast("int"))
    assert _column(spark, texts, int_prefix("v")) == lenient
    session_conf("spark.sql.ansi.enabled", "true")
    assert _column(spark, texts, int_prefix("v")) == lenient


@pytest.mark.parametrize(
    ("text", "money"),
    [("1e3", "1000.00"), ("2.345", "2.35"), ("0.001", "0.00"), ("1e20", None), ("NaN", None)],
)
def test_money(spark, text, money):
    (got,) = _column(spark, [text], to_money("v").cast("string"))
    assert got == money


def test_number_is_null_for_bad_text(spark):
    assert _column(spark, ["1,000", "abc", "", None], to_number("v")) == [None] * 4
