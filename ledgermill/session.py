"""Session building, cluster sizing and the shared scratch folder."""

from __future__ import annotations

import atexit
import math
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# One shuffle partition should hold about this much, so that it sorts in executor memory.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


# Fixed value: HotSpot never compiles a method of more bytecode than this.
JIT_METHOD_LIMIT = 8000

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Labelling and typing make one long projection. Fused into a single method it would stay
    # interpreted, which costs more than giving up the fusion for that stage.
    "spark.sql.codegen.hugeMethodLimit": str(JIT_METHOD_LIMIT),
}


def recommended_conf(shuffle_bytes: int) -> dict[str, str]:
    """Settings for a cluster run whose widest shuffle moves ``shuffle_bytes``.

    AQE merges the partitions again where the real size turns out smaller, so the initial number is
    chosen for the widest shuffle (the dedup of Silver, see README).
    """
    partitions = max(200, math.ceil(shuffle_bytes / TARGET_PARTITION_BYTES))
    return BASE_CONF | {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }


def build_session(
    app_name: str = "ledgermill", conf: dict[str, str] | None = None, master: str | None = None
) -> SparkSession:
    """Session in UTC; resources, and the master unless given, come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (BASE_CONF | (conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, root: str | None = None) -> str:
    """A fresh folder below the one named in ``spark.checkpoint.dir``.

    Executors write there, so it has to be storage that all of them see. Where the setting is missing,
    the folder set by ``setCheckpointDir`` counts, then ``root``. Only a single-machine session falls
    back on a local temporary folder; on a cluster that would scatter the data, so it is an error.
    """
    context = spark.sparkContext
    chosen = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or root
    if not chosen:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("name shared storage in spark.checkpoint.dir, or give a root")
        chosen = tempfile.mkdtemp(prefix="ledgermill-")
    return f"{chosen.rstrip('/')}/ledgermill-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for Arrow steps that import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package, folder = Path(__file__).resolve().parent, tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def _file_system(spark: SparkSession, path: str):
    """Hadoop file system holding ``path``, and the path as that system takes it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder matches a path or glob pattern."""
    files, hadoop_path = _file_system(spark, pattern)
    return bool(files.globStatus(hadoop_path))


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its file system, and absolute."""
    files, hadoop_path = _file_system(spark, path)
    return files.makeQualified(hadoop_path).toString()


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that match a glob pattern."""
    files, hadoop_path = _file_system(spark, pattern)
    return [str(status.getPath().toString()) for status in files.globStatus(hadoop_path) or []]


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``shared_folder``."""
    files, hadoop_path = _file_system(spark, path)
    files.delete(hadoop_path, True)
