"""Folders on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty if it is not there."""
    folder, files = _open(spark, path)
    if not files.exists(folder):
        return []
    return [status.getPath().getName() for status in files.listStatus(folder)]


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` with all below it; False if it was not there."""
    folder, files = _open(spark, path)
    return files.delete(folder, True)


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small text file."""
    file, files = _open(spark, path)
    stream = files.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that readers see whole or not at all; an error if it is there already."""
    file, files = _open(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(file.getParent(), f"_{file.getName()}.draft")
    if files.exists(file):
        raise FileExistsError(path)
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(draft, file):
        raise FileExistsError(path)
