"""The few file-system calls that are not DataFrame reads or writes (Hadoop FS, so any store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    return fs.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that isn't there yet, whole or not at all: written beside its place, then renamed."""
    fs, target = _fs(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(path + ".draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not fs.rename(draft, target):
        raise OSError(f"cannot write {path}")


def move(spark: SparkSession, path: str, target: str) -> None:
    """A folder to a place that isn't there yet, below a folder that may not be there either."""
    fs, source = _fs(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(source, to):
        raise OSError(f"cannot move {path} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.mkdirs(target)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0
