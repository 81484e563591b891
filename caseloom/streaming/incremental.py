"""Every new lake file exactly once into the star schema, whatever its format."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from caseloom.functions.scalars import missing_to_null
from caseloom.plans.flows import daily_staging
from caseloom.plans.warehouse import merge_staging
from caseloom.sources import files
from caseloom.sources.lake import by_format, by_name, csv_groups, replace_table, spark_path
from caseloom.sources.store import Store

CORRUPT = "_corrupt_record"
QUARANTINE = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "record")])
FILES_PER_BATCH = 1000
FILE_ROWS = "path string, modificationTime timestamp, length bigint, content binary"  # fixed schema of the binary source


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _fields(record: Column) -> Column:
    """Number of fields of a CSV record: its commas outside of quotes and one."""
    return F.size(F.split(F.regexp_replace(record, '"(?:[^"]|"")*"', ""), ",", -1))


def _read_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows of CSV files with one header, ``_corrupt_record`` set where a record has more fields than the header.

    Records with fewer fields are whole as far as they go, as in a batch load."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    names = reader.csv(spark_path(paths[0])).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, CORRUPT)])
    rows = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).csv([spark_path(p) for p in paths])
    broken = F.when(_fields(F.col(CORRUPT)) > len(names), F.col(CORRUPT))
    return rows.select(*[missing_to_null(_quoted(c)).alias(c) for c in names], broken.alias(CORRUPT), "_metadata.file_path")


def _read_json(spark: SparkSession, paths: Sequence[str], array: bool, schema: T.StructType | None) -> DataFrame:
    """Rows of JSON files, ``_corrupt_record`` set where there is no record to read."""
    reader = spark.read.option("primitivesAsString", True).option("multiLine", array).option("columnNameOfCorruptRecord", CORRUPT)
    places = [spark_path(p) for p in paths]
    fields = [f for f in (reader.json(places).schema if schema is None else schema).fields if f.name != CORRUPT]
    # Spark refuses to read the corrupt records alone, so files without any record get a column that stays empty.
    whole = T.StructType([*(fields or [T.StructField("_empty", T.StringType())]), T.StructField(CORRUPT, T.StringType())])
    return reader.schema(whole).json(places).select("*", "_metadata.file_path")


def read_new_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Rows of the given files, each in its own format, columns by name, and ``_corrupt_record`` and ``file_path`` beside them."""
    frames = []
    for kind, members in by_format(spark, paths).items():
        if kind == "csv":
            frames += [_read_csv(spark, group) for group in csv_groups(spark, members) if files.first_line(spark, group[0])]
        else:
            frames.append(_read_json(spark, members, kind == "json_array", schema))
    return by_name(frames or [spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in (CORRUPT, "file_path")]))])


def ingest_new_files(
    spark: SparkSession,
    lake: str,
    store: Store,
    staging_path: str,
    checkpoint: str,
    quarantine: str,
    files_per_batch: int = FILES_PER_BATCH,
    to_staging: Callable[[DataFrame], DataFrame] = daily_staging,
    schema: T.StructType | None = None,
) -> StreamingQuery:
    """Process the files that arrived since the last run, then stop.

    The stream itself carries file names only (the content column of the binary source is pruned away); each micro-batch
    reads its at most ``files_per_batch`` files in their own formats.  ``schema``: fields of JSON records, inferred per batch if
    None.  Records that cannot be read go to ``quarantine/batch=<number>`` as (file, record) and hold nothing else up.

    The checkpoint remembers finished files.  Each micro-batch is one store commit named after
    (checkpoint, batch number): if the driver dies between the commit and the checkpoint update, the
    repeated batch finds its own commit and adds nothing; its quarantine folder is written again, not twice.
    """

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        names = [r["path"] for r in batch.select("path").collect()]
        if not names:
            return
        read = replace_table(read_new_files(session, names, schema), f"{staging_path}/read={number}")
        broken = F.col(CORRUPT).isNotNull()
        read.where(broken).select(F.col("file_path").alias("file"), F.col(CORRUPT).alias("record")).write.mode("overwrite").parquet(
            f"{quarantine}/batch={number}"
        )
        rows = read.where(~broken).drop(CORRUPT, "file_path")
        if rows.isEmpty():
            return
        staging = replace_table(to_staging(rows), f"{staging_path}/batch={number}")
        merge_staging(store, staging, batch=f"{checkpoint}#{number}")
        files.delete(session, f"{staging_path}/read={number}")

    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_ROWS)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(lake)
        .select("path")
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    """(batch, file, record) of everything that could not be read."""
    schema = T.StructType([*QUARANTINE.fields, T.StructField("batch", T.LongType())])
    if not files.exists(spark, quarantine):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(quarantine)
