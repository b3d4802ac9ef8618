"""Folders of stored tables, on whatever file system their path names."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _open(spark, path)
    return files.exists(folder)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder and below."""
    files, folder = _open(spark, path)
    return files.getContentSummary(folder).getLength()


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders in a folder; none if it is missing."""
    files, folder = _open(spark, path)
    if not files.exists(folder):
        return []
    found = (s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory())
    return [name for name in found if "=" in name and not name.startswith((".", "_"))]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if it is missing."""
    files, folder = _open(spark, path)
    if not files.exists(folder):
        return []
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isFile()]


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    files, file = _open(spark, path)
    stream = files.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files of a table without partitions, as ``delete`` takes them."""
    hidden = (".", "_")
    return [f"{path}/{n}" for n in file_names(spark, path) if not n.startswith(hidden)]


def unescaped(spark: SparkSession, uri: str) -> str:
    """A path as it is written, from the escaped form in which Spark names files."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def delete(spark: SparkSession, paths: Iterable[str]) -> int:
    """Remove files or folders, given as they are written and not escaped. One that is
    gone already is no error; how many were there is returned."""
    removed = 0
    for path in paths:
        files, folder = _open(spark, path)
        removed += bool(files.delete(folder, True))
    return removed


def create(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Write a small file. Unless it may be overwritten, False if it is there already;
    of several that create it at once, one gets True."""
    files, file = _open(spark, path)
    files.mkdirs(file.getParent())
    try:
        stream = files.create(file, overwrite)
    except Py4JJavaError as error:
        if not overwrite and files.exists(file):
            return False
        raise error
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file; one that is there already stays."""
    files, file = _open(spark, path)
    files.mkdirs(file.getParent())
    files.createNewFile(file)
