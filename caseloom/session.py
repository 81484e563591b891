"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every caseloom job relies on.  The session time zone is pinned so that text -> timestamp
# is repeatable; everything about sizes (shuffle width, broadcast limit) stays with Spark and AQE.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Bytes a task reads at most where all its rows go into a wide shuffle: with Spark's 128 MB the rows of four tasks, unpacked,
# outgrow the memory of an executor and lie on its disk twice.
SPLIT_BYTES = 32 << 20

_local_folders: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app_name: str = "caseloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A temporary folder is used only where the setting is missing *and* the master is local, since a
    machine-local folder on a cluster would lose its files together with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="caseloom-")
    return _local_folders[context.applicationId]


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared folder (never reused, so no job reads another job's leftovers)."""
    name = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"
    return os.path.join(shared_folder(spark), name, *parts)


def estimated_bytes(df) -> int:
    """Size Spark's optimizer expects for ``df``: the number it compares with its broadcast limit."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """Spark's own limit for broadcasting a join side by its estimated size (-1: never)."""
    limit = spark.sql("SET spark.sql.autoBroadcastJoinThreshold").first()["value"]
    return -1 if limit.startswith("-") else _bytes(spark, limit)


def _bytes(spark: SparkSession, size: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size))


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_splits(spark: SparkSession):
    """Tasks of the jobs started inside read at most ``SPLIT_BYTES`` each, or less where the session says so."""
    key = "spark.sql.files.maxPartitionBytes"
    return configured(spark, {key: str(min(SPLIT_BYTES, _bytes(spark, spark.conf.get(key))))})


def sweep(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of finished steps when the driver collects its garbage; it rarely has to by itself."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, wherever they run; needed before tasks call into it."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="caseloom-package-"), "caseloom.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for module in sorted(package.rglob("*.py")):
            bundle.write(module, str(module.relative_to(package.parent)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
