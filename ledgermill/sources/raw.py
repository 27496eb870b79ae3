"""Raw payment CSV and its form as keyed messages."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions import step_day_index
from ledgermill.schema import PAYLOAD_FIELDS, PAYLOAD_SCHEMA
from ledgermill.session import path_exists, ship_package
from ledgermill.sources.multiline import read_records

# Delivery guarantees of the message writer.
DELIVERY_OPTIONS = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.compression.type": "lz4",
    "kafka.linger.ms": "50",
}


# A quote inside a quoted field is doubled. With enforceSchema off, each file's own header has to
# agree with the schema, so a file with other columns is an error and not misread.
CSV_OPTIONS = {"header": "true", "escape": '"', "enforceSchema": "false"}


# A cap of up to so many records is met on the driver.
HEAD_ROWS = 10_000


class MissingColumns(ValueError):
    """A CSV header lacks fields of the payload."""


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header CSV with every value kept as text; an empty field stays an empty text.

    Fields go by their names in the header, whatever their order; other columns are left out.
    ``multi_line`` allows line breaks inside quotes. A file is then still read by many tasks, in two
    passes (see ``multiline``).
    """
    schema = _header_schema(spark, path)
    if not multi_line:
        return _as_text(spark.read.schema(schema).options(**CSV_OPTIONS).csv(path))
    options = CSV_OPTIONS | {"multiLine": "true"}
    names = [f"`{name}` STRING" for name in schema.names]
    fields = F.from_csv("text", ", ".join(names), options)
    told = F.concat(F.lit("CSV header does not agree with the schema: "), "file")
    header = F.array(*[F.coalesce(F.col("fields")[name], F.lit("")) for name in schema.names])
    as_expected = header == F.array(*[F.lit(name) for name in schema.names])
    is_data = F.when(~F.col("first"), True).otherwise(
        F.when(as_expected, False).otherwise(F.raise_error(told).cast("boolean"))
    )
    records = read_records(spark, path).withColumn("fields", fields).filter(is_data)
    return _as_text(records.select("fields.*"))


def with_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``read_raw_csv`` with the hidden columns of the files still to be had."""
    schema = _header_schema(spark, path)
    files = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    return files.select(*PAYLOAD_FIELDS, "_metadata").na.fill("", PAYLOAD_FIELDS)


def stream_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The same for a folder that keeps receiving files; a checkpoint makes it resume.

    The header is that of the files present at the start; while there are none, it is expected to
    list the payload fields in order.
    """
    files = path_exists(spark, f"{path.rstrip('/')}/*")
    schema = _header_schema(spark, path) if files else PAYLOAD_SCHEMA
    return _as_text(spark.readStream.schema(schema).options(**CSV_OPTIONS).csv(path))


def _header_schema(spark: SparkSession, path: str) -> T.StructType:
    """All columns of the header as text."""
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    missing = [name for name in PAYLOAD_FIELDS if name not in names]
    if missing:
        raise MissingColumns(f"{path}: no column {', '.join(missing)}")
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _as_text(raw: DataFrame) -> DataFrame:
    return raw.select(PAYLOAD_FIELDS).na.fill("")


def first_days(raw: DataFrame, days: int) -> DataFrame:
    """Records of the first ``days`` event days; 0 keeps all. Row order plays no part."""
    return raw.filter(step_day_index("step") < days) if days else raw


def to_messages(raw: DataFrame, limit: int = 0) -> DataFrame:
    """One ``key, value`` message per record; the account key keeps its payments in order.

    ``limit`` caps the number of messages of a batch, 0 sends all.
    """
    capped = _first_rows(raw, limit) if limit else raw
    record = F.to_json(F.struct(*PAYLOAD_FIELDS), {"ignoreNullFields": "false"})
    return capped.select(F.col("nameOrig").alias("key"), record.alias("value"))


def _first_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by partition and place, without moving them to one task.

    Up to ``HEAD_ROWS`` come from the first splits that hold enough. Beyond that, partitions are counted
    in growing steps until there are enough, and those after the cut give up before they read their split.
    """
    if n <= HEAD_ROWS:
        return rows.sparkSession.createDataFrame(rows.head(n), rows.schema)
    ship_package(rows.sparkSession)
    counts = rows.mapInArrow(_count_rows, "n long")
    seen, step = [], 1
    while sum(seen) < n and len(seen) < step:
        taken = [row.n for row in counts.take(step)]
        if len(taken) <= len(seen):
            return rows
        seen, step = taken, 4 * step if len(taken) == step else step
    if sum(seen) < n:
        return rows
    cut, before = 0, 0
    while before + seen[cut] < n:
        before += seen[cut]
        cut += 1

    def first(batches):
        from pyspark import TaskContext

        at, left = TaskContext.get().partitionId(), n - before
        if at > cut:
            return
        for batch in batches:
            yield batch if at < cut else batch.slice(0, left)
            left -= batch.num_rows
            if at == cut and left <= 0:
                return

    return rows.mapInArrow(first, rows.schema)


def _count_rows(batches):
    """One row for each partition."""
    yield pa.RecordBatch.from_arrays([pa.array([sum(batch.num_rows for batch in batches)])], ["n"])


def delivery_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **DELIVERY_OPTIONS}


def write_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch publish. Needs the public ``spark-sql-kafka-0-10`` package on the classpath."""
    messages.write.format("kafka").options(**delivery_options(servers, topic)).save()


def publish_stream(messages: DataFrame, servers: str, topic: str, checkpoint: str):
    """Publish a message stream; a restart goes on after what its checkpoint has recorded."""
    return (
        messages.writeStream.format("kafka")
        .options(**delivery_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
