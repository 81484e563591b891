"""What the operators share: Arrow batches, stored intermediate tables, word hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from caseloom.session import configured, ship_package, sweep, work_path
from caseloom.sources import files

# Rows Spark hands to a Python task at once.  Texts differ in length a thousandfold, so the default of 10,000
# rows could be gigabytes; this keeps a batch at a few MB of ordinary documents.
BATCH_ROWS = 2048
OPEN_SLICES = 8  # files a task writes side by side; rows of tables with more slices are sorted

Arrays = dict[str, object]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, slices: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, and safe when executors are lost.

    ``slices``: the table's last column, whose values get a folder each, so that a filter on it reads only its own files.  A task
    keeps a file open for each of a few values instead of sorting its rows by them."""
    spark = df.sparkSession
    path = work_path(spark, name)
    with configured(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_SLICES)} if slices else {}):
        df.write.option("compression", "zstd").parquet(path, partitionBy=slices)
    sweep(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that only finished steps have read."""
    for df in tables:
        files.delete(df.sparkSession, df.stored_at)


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with bounded batches and this package on the workers, which hand back their memory after each task."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        hand_back()

    return df.mapInArrow(run, schema)


def hand_back() -> None:
    """Return memory that a finished task has freed: Python workers wait for the next stage with what their allocators keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings, NULL as ''."""
    return [x or "" for x in column.to_pylist()]


# ---------------------------------------------------------------- word hashes
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values: a plain sort, which for numbers beats the hash table behind ``np.unique``."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if values.size else values


def _powers(n: int) -> np.ndarray:
    base = np.full(n, np.uint64(0xD6E8FEB86659FD93))
    base[0] = 1
    return np.multiply.accumulate(base)


_POWERS = _powers(4096)


def word_hashes(text: bytes, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes, in order; A-Z lowered if asked."""
    if lower:
        text = text.lower()  # bytes.lower touches A-Z only
    raw = np.frombuffer(text, np.uint8)
    if not raw.size:
        return np.empty(0, np.uint64)
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    if not begin.size:
        return np.empty(0, np.uint64)
    size = end - begin
    powers = _POWERS if size.max() <= len(_POWERS) else _powers(int(size.max()))
    inside = np.flatnonzero(word)
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(inside.size) - np.repeat(first, size)
    value = (raw[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64) * _ODD)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; empty when there are fewer."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, width):
        out = mix(out) + words[k : k + n] * _ODD
    return mix(out)
