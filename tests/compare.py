"""Run the registered queries in Spark and in DuckDB and compare names, types and values."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _normal(value):
    return round(value, 9) if isinstance(value, float) else value


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and the result of ``sql``; empty if nothing does."""
    result = connection.execute(sql)
    wanted_names = [column[0] for column in result.description]
    if sorted(df.columns) != sorted(wanted_names):
        return [f"columns {sorted(df.columns)} != {sorted(wanted_names)}"]
    wanted_types = {column[0]: str(column[1]) for column in result.description}
    found = []
    for name, spark_type in df.dtypes:
        expected = TYPES.get(spark_type, spark_type.upper())
        if wanted_types[name] != expected:
            found.append(f"type of {name}: {spark_type} != {wanted_types[name]}")
    names = sorted(df.columns)
    wanted = Counter(
        tuple(_normal(dict(zip(wanted_names, row))[name]) for name in names)
        for row in result.fetchall()
    )
    got = Counter(tuple(_normal(row[name]) for name in names) for row in df.collect())
    if got != wanted:
        extra, missing = list((got - wanted).items()), list((wanted - got).items())
        found.append(
            f"{sum(got.values())} rows against {sum(wanted.values())}; "
            f"only Spark {extra[:3]}; only SQL {missing[:3]}"
        )
    return found


def main() -> int:
    import __spark_entry__ as entry_module

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle, bad = open_tables(sf_dir), entry_module.oracle_sql(), 0
    for name, query in entry_module.queries().items():
        if chosen and name not in chosen:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                found = differences(df, connection, oracle[name])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as error:  # report all queries, not just the first bad one
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.2f}s", *found, sep="\n     ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
