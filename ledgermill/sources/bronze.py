"""Bronze: flat JSON lines below ``date=YYYY-MM-DD/batch=N`` folders, by ingest day and landing batch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import ingest_date
from ledgermill.schema import BRONZE_SCHEMA, CORRUPT_FIELD, RAW_VALUE_FIELD, as_day
from ledgermill.session import list_paths

# Partition below the ingest day: the batch that landed the records.
BATCH_FIELD = "batch"

READ_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields
    + [
        T.StructField(RAW_VALUE_FIELD, T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField(CORRUPT_FIELD, T.StringType()),
    ]
)


def read_bronze(
    spark: SparkSession,
    path: str,
    ingest_from: date | str | None = None,
    ingest_to: date | str | None = None,
) -> DataFrame:
    """Bronze as text columns, without an inference pass.

    A line that is no JSON comes back with all fields NULL and its text in ``_corrupt_record``.
    ``ingest_from`` / ``ingest_to`` (inclusive) prune whole ``date`` folders before any line is
    parsed, the only cheap cut that this layout offers. Records without a record time have no
    ingest day and are always read. A load of some event days may only be given such a window if it
    covers every ingest day on which their records, late ones included, came in.
    """
    bronze = (
        spark.read.schema(READ_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_FIELD)
        .json(path)
        .select(READ_SCHEMA.fieldNames())
    )
    undated = F.col("date").isNull()
    if ingest_from is not None:
        bronze = bronze.filter(undated | (F.col("date") >= F.lit(as_day(ingest_from))))
    if ingest_to is not None:
        bronze = bronze.filter(undated | (F.col("date") <= F.lit(as_day(ingest_to))))
    return bronze


def write_batch(rows: DataFrame, path: str, number: int, roll_records: int = 0) -> None:
    """Land rows that have their ``date`` as batch ``number`` of a feed.

    Landing the same batch again replaces its folders, and only those. Files are rolled after
    ``roll_records`` records, 0 sets no limit.
    """
    (
        rows.withColumn(BATCH_FIELD, F.lit(number))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", roll_records)
        .partitionBy("date", BATCH_FIELD)
        .json(path)
    )


def write_bronze(bronze: DataFrame, path: str) -> None:
    """Land records outside a feed, in a batch of its own after those that are there.

    The rebalance keeps the number of files near size / advisory partition size, and splits a day
    that holds most of the rows over several tasks. A folder has one kind of writer: a feed numbers its
    batches by its checkpoint.
    """
    found = list_paths(bronze.sparkSession, f"{path.rstrip('/')}/date=*/{BATCH_FIELD}=*")
    number = max((int(name.rsplit("=", 1)[1]) for name in found), default=-1) + 1
    rows = bronze.withColumn("date", ingest_date("kafka_timestamp"))
    write_batch(rows.hint("rebalance", "date"), path, number)
