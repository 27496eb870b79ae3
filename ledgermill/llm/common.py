"""Shared by the operators: table reading and scratch tables that cut lineage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgermill.session import shared_folder

# Fixed value: the white space that separates words, as a Java regular expression class body.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to a fresh folder of the shared scratch storage, and read from there.

    Everything built on the result survives lost executors by re-reading the folder. It stays as long
    as results are read from it, so nothing here removes it.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


_shipped: set[str] = set()


def _ship() -> None:
    """Send this package to the executors, once per application."""
    context = SparkSession.getActiveSession().sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, task, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` for a task that imports this package."""
    _ship()
    return df.mapInArrow(task, schema)


def apply_arrow(groups: GroupedData, task, schema: str | StructType) -> DataFrame:
    """``applyInArrow`` for a task that imports this package."""
    _ship()
    return groups.applyInArrow(task, schema)


def cogroup_arrow(left: GroupedData, right: GroupedData, task, schema: str | StructType) -> DataFrame:
    """``applyInArrow`` on two grouped tables, for a task that imports this package."""
    _ship()
    return left.cogroup(right).applyInArrow(task, schema)


def hash_share(rows: DataFrame, key: str, wanted: int) -> DataFrame:
    """All rows if there are few, else those of a share of the key's hashes: about twice ``wanted``.

    A following sort and limit then meets a bounded number of rows, however many tasks there are.
    """
    n, parts = rows.count(), 1 << 30
    if n <= 2 * wanted:
        return rows
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(parts)) < F.lit(parts * 2 * wanted // n + 1))


def small_batches(batches, rows: int = 256):
    """Arrow batches cut to so many rows, so that Python objects exist for few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def row_schema(row: StructField, rest: str) -> StructType:
    """A field, as it is, and more fields in DDL; safe for structs with any column names."""
    return StructType([row, *StructType.fromDDL(rest).fields])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    A plain column would be copied into the body, and inside a lambda be computed for each element.
    """
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text as an array; NULL counts as the empty text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+", -1), "")
