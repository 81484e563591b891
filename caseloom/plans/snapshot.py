"""Verified copies of a set of tables and of model files."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.sources import files

MANIFEST = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("checksum", T.StringType()),
    ]
)


FILE_MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("size", T.LongType()),
    ]
)
COPIES = 16  # files copied at once


class SnapshotMismatch(ValueError):
    """Stored rows do not match the manifest."""


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (rows, checksum): a sum of row hashes, so neither order nor partitioning matters."""
    row_hash = F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(row_hash), F.lit(0)).cast("string").alias("checksum")
    )


def snapshot(spark: SparkSession, tables: Mapping[str, DataFrame], destination: str, at: datetime) -> str:
    """Write every table below ``destination/<time>``; the manifest comes last and makes it valid."""
    folder = f"{destination.rstrip('/')}/{at:%Y%m%d_%H%M%S}"
    manifest = None
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")
        copied = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        entry = fingerprint(copied).select(F.lit(name).alias("table"), "rows", "checksum")
        manifest = entry if manifest is None else manifest.unionByName(entry)
    manifest.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/_manifest")
    return folder


# ---------------------------------------------------------------- files
def file_hashes(spark: SparkSession, root: str) -> DataFrame:
    """(path below ``root``, sha256, size) of every file; contents are hashed where they are read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # 'file:/x' and 'file:///x' name the same place: compare what follows the scheme
    base = files.filesystem(spark, root).makeQualified(spark._jvm.org.apache.hadoop.fs.Path(root)).toUri().getPath().rstrip("/")
    inside = F.substring_index(F.col("path"), f"{base}/", -1)
    return listing.select(inside.alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def snapshot_files(spark: SparkSession, root: str, destination: str, folder: str) -> None:
    """Copy the files below ``root``: each content once into ``destination/blobs``, shared by all snapshots there, and their
    names with SHA-256 into the snapshot, last.  Meant for models, whose size follows from their settings; files are streamed."""
    empty = not files.exists(spark, root)
    found = [] if empty else file_hashes(spark, root).collect()
    blobs = f"{destination.rstrip('/')}/blobs"
    files.make_folder(spark, blobs)
    first = {r["sha256"]: r["path"] for r in found}

    def keep(entry: tuple[str, str]) -> None:
        sha256, path = entry
        if not files.exists(spark, f"{blobs}/{sha256}"):
            files.copy(spark, f"{root}/{path}", f"{blobs}/{sha256}")

    with ThreadPoolExecutor(max_workers=COPIES) as pool:
        list(pool.map(keep, first.items()))
    spark.createDataFrame([tuple(r) for r in found], FILE_MANIFEST).coalesce(1).write.parquet(f"{folder}/_files")


def restore_files(spark: SparkSession, folder: str, destination: str, root: str) -> None:
    """Write a snapshot's files below ``root`` and compare all of them with the manifest."""
    wanted = [tuple(r) for r in spark.read.schema(FILE_MANIFEST).parquet(f"{folder}/_files").collect()]
    blobs = f"{destination.rstrip('/')}/blobs"

    def fetch(entry: tuple[str, str, int]) -> None:
        path, sha256, _ = entry
        files.make_folder(spark, f"{root}/{path}".rsplit("/", 1)[0])
        files.copy(spark, f"{blobs}/{sha256}", f"{root}/{path}")

    with ThreadPoolExecutor(max_workers=COPIES) as pool:
        list(pool.map(fetch, wanted))
    found = {tuple(r) for r in file_hashes(spark, root).collect()} if wanted else set()
    if not set(wanted) <= found:
        raise SnapshotMismatch(f"files {sorted(set(wanted) - found)[:3]} differ from the manifest")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def verify(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a snapshot, each compared with the manifest first."""
    expected = {r["table"]: (r["rows"], r["checksum"]) for r in read_manifest(spark, folder).collect()}
    tables = {}
    for name, entry in expected.items():
        tables[name] = spark.read.parquet(f"{folder}/{name}")
        found = fingerprint(tables[name]).first()
        if (found["rows"], found["checksum"]) != entry:
            raise SnapshotMismatch(f"{name}: {tuple(found)} instead of {entry}")
    return tables


def restore(spark: SparkSession, folder: str, target: str) -> None:
    """Replace the tables below ``target`` by the snapshot's, after all of them verified."""
    for name, df in verify(spark, folder).items():
        df.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{name}")


def exists(spark: SparkSession, folder: str) -> bool:
    return files.exists(spark, f"{folder}/_manifest")
