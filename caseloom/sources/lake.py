"""The raw data lake: JSON and CSV extracts on any Hadoop file system."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.scalars import missing_to_null
from caseloom.sources import files


PROBES = 32  # files looked into at once


class EmptyInput(ValueError):
    """An input that must hold rows holds none."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyInput(f"{what} has no rows")
    return df


# ---------------------------------------------------------------- reading
def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, array: bool = False
) -> DataFrame:
    """JSON lines (splittable), or with ``array`` one JSON array per file.

    Without a schema every field is read as text in a single inference pass.  With one, a record that is no JSON ends the
    job that meets it; it never becomes a row of NULL.
    """
    reader = spark.read.option("primitivesAsString", True).option("multiLine", array)
    return (reader.schema(schema).option("mode", "FAILFAST") if schema else reader).json(path)


def read_csv(
    spark: SparkSession, path: str | Sequence[str], quoted_newlines: bool = False
) -> DataFrame:
    """CSV with a header, every column as text, missing-value markers as NULL.  Several files are matched by column name.

    Nothing is inferred, so the file is scanned once and stays splittable; only files with line
    breaks inside quotes need ``quoted_newlines``, which reads each file in one task.
    """
    paths = [path] if isinstance(path, str) else list(path)
    members = [file for p in paths for file in _data_files(spark, p)]
    if not members:
        raise EmptyInput(f"{', '.join(paths)} holds no files")
    return by_name([_csv_of_one_header(spark, group, quoted_newlines) for group in csv_groups(spark, members)])


def _csv_of_one_header(spark: SparkSession, paths: Sequence[str], quoted_newlines: bool = False) -> DataFrame:
    df = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", quoted_newlines)
        .csv([spark_path(p) for p in paths])
    )
    quoted = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    return df.select(*[missing_to_null(F.col(q)).alias(c) for q, c in zip(quoted, df.columns)])


def csv_groups(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """CSV files by their header line: Spark binds the columns of one read by position, so only files with the same
    header may share one.  Files without a line are left out, unless there are no others.

    A file is opened for its first block only, ``PROBES`` at once.
    """
    groups: dict[str, list[str]] = {}
    for file, line in zip(paths, _probed(lambda p: files.first_line(spark, p), paths)):
        if line is not None:
            groups.setdefault(line, []).append(file)
    return [groups[line] for line in sorted(groups)] or [list(paths)]


def _probed(look: Callable[[str], object], paths: Sequence[str]) -> list:
    with ThreadPoolExecutor(max_workers=PROBES) as pool:
        return list(pool.map(look, paths))


def spark_path(path: str) -> str:
    """A path whose characters stand for themselves where Spark would expand patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, missing ones as NULL."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """Files of a lake object; part files of a folder may lie in folders below it."""
    if not files.is_directory(spark, path):
        return [path]
    below = [f"{path.rstrip('/')}/{n}" for n in files.children(spark, path)]
    return [file for p in below for file in _data_files(spark, p)]


def format_of(spark: SparkSession, file: str, within: str = "", otherwise: str = "json") -> str:
    """'csv', 'json_array' or 'json_lines' of one file: by its ending, else by that of the object it belongs to, else
    ``otherwise`` (daily extracts: JSON unless called CSV; research extracts: CSV unless called JSON).  JSON is an array if its
    first character that is no blank says so."""
    for name in (file, within):
        bare = name.rstrip("/").lower()
        for suffix in (".gz", ".bz2", ".zst", ".snappy"):
            bare = bare.removesuffix(suffix)
        if bare.endswith((".csv", ".json")):
            kind = bare.rsplit(".", 1)[1]
            break
    else:
        kind = otherwise
    if kind == "csv":
        return "csv"
    return "json_array" if files.first_character(spark, file) == "[" else "json_lines"


def by_format(spark: SparkSession, data: Sequence[str], within: str = "", otherwise: str = "json") -> dict[str, list[str]]:
    """Format -> the files that have it."""
    kinds: dict[str, list[str]] = {}
    for file, kind in zip(data, _probed(lambda f: format_of(spark, f, within, otherwise), data)):
        kinds.setdefault(kind, []).append(file)
    return dict(sorted(kinds.items()))


def read_lake(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None, otherwise: str = "json"
) -> DataFrame:
    """One lake object (a file, or a folder of part files).  Each file is read in its own format, and columns are matched by
    name.  JSON that cannot be read stops the load instead of becoming rows of NULL: at once when the schema is inferred, with
    the first job that reads it when ``schema`` is given."""
    data = _data_files(spark, path)
    if not data:
        raise EmptyInput(f"{path} holds no files")
    frames = []
    for kind, members in ({fmt: data} if fmt else by_format(spark, data, path, otherwise)).items():
        if kind == "csv":
            df = read_csv(spark, members)
        else:
            df = read_json(spark, [spark_path(m) for m in members], schema, array=kind == "json_array")
        if "_corrupt_record" in df.columns:
            raise ValueError(f"{path} holds {kind} files with text that is no JSON record")
        frames.append(df)
    return by_name(frames)


def csv_header(
    spark: SparkSession, path: str, rule: Callable[[str], str] = str
) -> list[str]:
    """Normalised header names; only the first line is looked at."""
    return [rule(c) for c in spark.read.option("header", True).csv(path).columns]


def latest_object(spark: SparkSession, lake: str) -> str | None:
    """The lake object (entry directly below ``lake``) modified last; None for an empty lake.

    The listing runs through Spark's file source, whose content column is pruned away, so only file
    status is read and large lakes are listed in parallel.
    """
    if not files.children(spark, lake):
        return None
    root = spark._jvm.org.apache.hadoop.fs.Path(lake)
    prefix = files.filesystem(spark, lake).makeQualified(root).toString().rstrip("/") + "/"
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(lake)
        .select("path", "modificationTime")
    )
    # 'file:/x' and 'file:///x' name the same place, so both sides lose their extra slashes.
    scheme, rest = prefix.split(":", 1)
    skip = len(f"{scheme}:/{rest.lstrip('/')}")
    collapsed = F.regexp_replace("path", r"^(\w+:)/*", "$1/")
    inside = F.substring_index(F.substr(collapsed, F.lit(skip + 1)), "/", 1)
    newest = (
        listing.groupBy(inside.alias("name"))
        .agg(F.max("modificationTime").alias("modified"))
        .orderBy(F.desc("modified"), F.desc("name"))
        .first()
    )
    return None if newest is None else f"{lake.rstrip('/')}/{newest['name']}"


def preferred_object(spark: SparkSession, lake: str, name: str) -> str:
    """The object called ``name`` if it exists, else the latest one."""
    fixed = f"{lake.rstrip('/')}/{name}"
    if files.exists(spark, fixed):
        return fixed
    found = latest_object(spark, lake)
    if found is None:
        raise EmptyInput(f"{lake} is empty")
    return found


def content_version(spark: SparkSession, path: str) -> str:
    """Name of what a file or folder holds now: its path with the times and sizes of all its files.

    A file rewritten at the same path has another version; the same files always have the same."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    seen = F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))
    files_seen, total = listing.agg(F.count("*"), seen).first()
    return f"{path}@{files_seen}:{total}"


# ---------------------------------------------------------------- writing
def latest_records(records: DataFrame, order: str = "date_occ", n: int = 2000) -> DataFrame:
    """The newest ``n`` records; a top-n, so only n rows per task ever leave the scan."""
    ties = [F.asc_nulls_last(c) for c in records.columns if c != order]
    return records.orderBy(F.desc_nulls_last(order), *ties).limit(n)


def land_extract(records: DataFrame, lake: str, prefix: str, at: datetime, compression: str = "none") -> str:
    """Write one timestamped extract of JSON lines; an extract is never overwritten.

    The records are worked out once: whether there are any is seen in the files, and an extract without records is taken back."""
    target = f"{lake.rstrip('/')}/{prefix}_{at:%Y%m%d_%H%M%S}.json"
    records.write.mode("errorifexists").option("compression", compression).json(target)
    try:
        require_rows(records.sparkSession.read.text(spark_path(target)), f"extract {prefix}")
    except EmptyInput:
        files.delete(records.sparkSession, target)
        raise
    return target


def replace_table(df: DataFrame, path: str, folders: str | None = None) -> DataFrame:
    """Overwrite a staging table and read it back, which also cuts the lineage.

    ``folders``: the table's last column, whose values get a folder each, so that a filter on it reads only its own files."""
    df.write.mode("overwrite").parquet(path, partitionBy=folders)
    return df.sparkSession.read.schema(df.schema).parquet(path)
