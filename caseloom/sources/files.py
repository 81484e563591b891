"""Small driver-side helpers on the Hadoop file system API (listing, pointers, first bytes)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def filesystem(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, text: str) -> bool:
    return filesystem(spark, text).exists(_path(spark, text))


def is_directory(spark: SparkSession, text: str) -> bool:
    fs, path = filesystem(spark, text), _path(spark, text)
    return fs.exists(path) and fs.getFileStatus(path).isDirectory()


def children(spark: SparkSession, text: str) -> list[str]:
    """Names directly below ``text``, hidden ones left out."""
    fs, path = filesystem(spark, text), _path(spark, text)
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def read_small_text(spark: SparkSession, text: str) -> str:
    stream = filesystem(spark, text).open(_path(spark, text))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _opened(spark: SparkSession, text: str):
    """Stream over a file's content, unpacked by its codec."""
    path = _path(spark, text)
    stream = filesystem(spark, text).open(path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    return stream if codec is None else codec.createInputStream(stream)


def first_character(spark: SparkSession, text: str) -> str:
    """First character of a file that is no blank, unpacked by its codec; '' when there is none."""
    stream = _opened(spark, text)
    try:
        while (byte := stream.read()) >= 0:
            if byte < 128 and not chr(byte).isspace():
                return chr(byte)
        return ""
    finally:
        stream.close()


def first_line(spark: SparkSession, text: str) -> str | None:
    """First line of a file that is not blank, unpacked by its codec; None when there is none."""
    stream = _opened(spark, text)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        while (line := reader.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        reader.close()


def publish_text(spark: SparkSession, target: str, content: str) -> None:
    """Write beside the target, then rename: readers see the whole file or none.

    Fails when the target exists, which is what makes a numbered commit file a lock.
    """
    staged = target.rsplit("/", 1)
    temporary = f"{staged[0]}/_{staged[1]}.{spark._jvm.java.util.UUID.randomUUID().toString()}"
    fs = filesystem(spark, target)
    stream = fs.create(_path(spark, temporary), False)
    try:
        stream.write(bytearray(content, "utf-8"))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    no_options = spark.sparkContext._gateway.new_array(
        spark._jvm.org.apache.hadoop.fs.Options.Rename, 0
    )
    context.rename(_path(spark, temporary), _path(spark, target), no_options)


def delete(spark: SparkSession, text: str) -> None:
    filesystem(spark, text).delete(_path(spark, text), True)


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copy one file as a stream; readers of the target see the whole file or none."""
    configuration = spark._jsc.hadoopConfiguration()
    fs = filesystem(spark, target)
    staged = f"{target}.{spark._jvm.java.util.UUID.randomUUID().toString()}"
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        filesystem(spark, source), _path(spark, source), fs, _path(spark, staged), False, configuration
    )
    if not fs.rename(_path(spark, staged), _path(spark, target)):
        delete(spark, staged)
        if not exists(spark, target):
            raise OSError(f"cannot write {target}")


def make_folder(spark: SparkSession, text: str) -> None:
    filesystem(spark, text).mkdirs(_path(spark, text))
