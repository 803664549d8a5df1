"""Looking at folders on whatever file system the cluster uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    file_system, location = _locate(spark, path)
    return file_system.exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty if it does not exist."""
    file_system, location = _locate(spark, path)
    if not file_system.exists(location):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(location)]


def read_text(spark: SparkSession, path: str) -> str:
    file_system, location = _locate(spark, path)
    stream = file_system.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file so that a reader sees it whole or not at all; nothing that is there is replaced."""
    file_system, location = _locate(spark, path)
    partial = location.suffix(".partial")
    stream = file_system.create(partial, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if file_system.exists(location) or not file_system.rename(partial, location):
        raise OSError(f"could not rename {partial} to {location}")


def delete(spark: SparkSession, path: str) -> None:
    file_system, location = _locate(spark, path)
    file_system.delete(location, True)
