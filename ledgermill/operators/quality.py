"""Declarative expectations on tables.

Each expectation yields one row: ``failures`` is the number of violations that the check lists
(NULL rows, repeated values, or foreign values), ``failed_rows`` the number of table rows behind
them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ledgermill.schema import FRAUD_TYPES, PAYMENT_TYPES


class ExpectationFailed(RuntimeError):
    """At least one expectation found violations."""


@dataclass(frozen=True)
class Expectation:
    table: str
    check: str
    column: str
    values: tuple = ()


# The expectations that hold for the published tables.
EXPECTATIONS = [
    Expectation("silver", "not_null", "row_id"),
    Expectation("silver", "unique", "row_id"),
    Expectation("silver", "not_null", "is_suspicious"),
    Expectation("silver", "accepted_values", "type", tuple(PAYMENT_TYPES)),
    Expectation("undetected_fraud", "not_null", "row_id"),
    Expectation("undetected_fraud", "unique", "row_id"),
    Expectation("undetected_fraud", "accepted_values", "is_suspicious", (True,)),
    Expectation("undetected_fraud", "accepted_values", "type", tuple(FRAUD_TYPES)),
    Expectation("hourly_summary", "not_null", "tx_hour"),
    Expectation("account_risk", "not_null", "account_id"),
    Expectation("account_risk", "unique", "account_id"),
    Expectation("account_risk", "not_null", "fraud_tx_count"),
]

RESULT_COLUMNS = ["table_name", "check_name", "column_name", "failures", "failed_rows"]


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a value, for all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return (
        counts.unpivot([], list(columns), "column_name", "failures")
        .withColumn("check_name", F.lit("not_null"))
        .withColumn("failed_rows", F.col("failures"))
    )


def unique(df: DataFrame, column: str, key_local: bool = False) -> DataFrame:
    """Values that occur more than once; NULL is no value.

    All rows are counted by a 64-bit hash, so only eight bytes of a long key are shuffled; the few
    values whose hash occurs again are then counted in full. ``key_local`` counts the values themselves in
    one pass, which needs no shuffle where the table is bucketed by the column.
    """
    if key_local:
        values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return _violations(values.filter("n > 1"), "unique", column)
    return _violations(_repeated(df.withColumn("no_day", F.lit(0)), "no_day", column), "unique", column)


def _repeated(df: DataFrame, day: str, column: str) -> DataFrame:
    """(day, value, n) of the values that occur more than once on a day."""
    values = df.filter(F.col(column).isNotNull()).select(
        day, F.col(column).alias("value"), F.xxhash64(column).alias("hash")
    )
    again = values.groupBy(day, "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = again.select(F.col(day).alias("d"), F.col("hash").alias("twice"))
    return (
        values.join(twice, (F.col("hash") == F.col("twice")) & (F.col(day) == F.col("d")), "left_semi")
        .groupBy(day, "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list; NULL passes."""
    return _foreign_values(df, {column: values})


def _foreign_values(df: DataFrame, lists: dict[str, Sequence]) -> DataFrame:
    """``accepted_values`` for all columns in one pass."""
    foreign = [
        F.when(~F.col(column).isin(list(values)), F.struct(F.lit(column).alias("c"), F.col(column).cast("string").alias("v")))
        for column, values in lists.items()
    ]
    found = (
        df.select(F.explode(F.array_compact(F.array(*foreign))).alias("f"))
        .groupBy("f.c", "f.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A group for each column, also where it has no foreign value.
    total = found.agg(
        *[F.count_if(F.col("c") == column).alias(f"f{i}") for i, column in enumerate(lists)],
        *[F.sum(F.when(F.col("c") == column, F.col("n"))).alias(f"r{i}") for i, column in enumerate(lists)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit("accepted_values").alias("check_name"),
                F.lit(column).alias("column_name"),
                F.col(f"f{i}").alias("failures"),
                F.coalesce(f"r{i}", F.lit(0)).alias("failed_rows"),
            )
            for i, column in enumerate(lists)
        ]
    )
    return total.select(F.inline(rows))


def _violations(values: DataFrame, check: str, column: str) -> DataFrame:
    return values.agg(
        F.count(F.lit(1)).alias("failures"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("failed_rows"),
    ).select(
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        "failures",
        "failed_rows",
    )


def evaluate(
    tables: dict[str, DataFrame], expectations: Sequence[Expectation] = tuple(EXPECTATIONS)
) -> DataFrame:
    """Result rows of all expectations on the given tables."""
    results = []
    for name, df in tables.items():
        own = [e for e in expectations if e.table == name]
        required = [e.column for e in own if e.check == "not_null"]
        parts = [not_null(df, required)] if required else []
        parts += [unique(df, e.column) for e in own if e.check == "unique"]
        lists = {e.column: e.values for e in own if e.check == "accepted_values"}
        parts += [_foreign_values(df, lists)] if lists else []
        results += [part.withColumn("table_name", F.lit(name)) for part in parts]
    return reduce(DataFrame.unionByName, results).select(RESULT_COLUMNS)


def evaluate_by_day(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """``tx_date, table_name, check_name, column_name, value, failures, failed_rows`` of what fails by day.

    The expectations are those of one table. Missing values and repeated ones are numbers by day; foreign
    values are a row each, as the same one may occur on other days.
    """
    day = "tx_date"
    parts = []
    for e in expectations:
        value = F.lit(None).cast("string")
        if e.check == "not_null":
            bad = df.filter(F.col(e.column).isNull()).groupBy(day).agg(F.count(F.lit(1)).alias("n"))
            found = bad.select(day, value.alias("value"), F.col("n").alias("failures"), F.col("n").alias("failed_rows"))
        elif e.check == "unique":
            found = _repeated(df, day, e.column).groupBy(day).agg(
                F.count(F.lit(1)).alias("failures"), F.sum("n").alias("failed_rows")
            ).withColumn("value", value)
        else:
            foreign = df.filter(~F.col(e.column).isin(list(e.values)))
            found = foreign.groupBy(day, F.col(e.column).cast("string").alias("value")).agg(
                F.lit(1).cast("long").alias("failures"), F.count(F.lit(1)).alias("failed_rows")
            )
        named = {"table_name": F.lit(e.table), "check_name": F.lit(e.check), "column_name": F.lit(e.column)}
        parts.append(found.withColumns(named))
    return reduce(DataFrame.unionByName, parts)


def check_expectations(results: Iterable[Row]) -> None:
    """Raise with the violated expectations among the collected result rows."""
    broken = [row for row in results if row.failures > 0]
    if broken:
        found = "; ".join(
            f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in broken
        )
        raise ExpectationFailed(found)
