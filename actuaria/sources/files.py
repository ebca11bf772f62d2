"""File listings and first lines through Hadoop's file system, for any store Spark can reach."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FileInfo:
    path: str
    name: str
    length: int
    modified: dt.datetime


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return bool(fs.exists(p))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority, as Spark itself resolves it."""
    fs, p = _open(spark, path)
    return str(fs.makeQualified(p).toString())


def list_files(spark: SparkSession, folder: str) -> list[FileInfo]:
    """The files directly in ``folder``; a missing folder is an error."""
    fs, p = _open(spark, folder)
    found = []
    for s in fs.listStatus(p):
        if s.isFile():
            when = dt.datetime.fromtimestamp(s.getModificationTime() / 1000, dt.timezone.utc).replace(tzinfo=None)
            found.append(FileInfo(str(s.getPath().toString()), str(s.getPath().getName()), int(s.getLen()), when))
    return sorted(found, key=lambda f: f.name)


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """The names of the folders directly in ``folder``; none if it does not exist."""
    fs, p = _open(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory())


def tree(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(path, length, modified ms) of every file below ``folder``, or of the file that it is."""
    fs, p = _open(spark, folder)
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        s = files.next()
        found.append((str(s.getPath().toString()), int(s.getLen()), int(s.getModificationTime())))
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str | None:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        java = spark._jvm.java.io
        return java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with this text; False if there is one of the name already."""
    fs, p = _open(spark, path)
    try:
        stream = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The first line of a small file; nothing if it is empty or gone."""
    try:
        return first_line(spark, path) or ""
    except Py4JJavaError:
        if exists(spark, path):
            raise
        return ""


def delete(spark: SparkSession, path: str) -> None:
    """Take away a file, or a folder with what is in it."""
    fs, p = _open(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Move a file to a path that is free, its folder made if need be."""
    fs, p = _open(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"{path} was not moved to {target}")


def move_into(spark: SparkSession, path: str, folder: str) -> str:
    """Move a file into ``folder`` (made if need be); returns its new path.

    Where its name is taken, the time is set before it, so that no older file is lost (S7).
    """
    fs, p = _open(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path
    target, tried = new(folder, p.getName()), 0
    fs.mkdirs(target.getParent())
    while fs.exists(target):
        stamp = dt.datetime.now().strftime("%Y%m%d_%H%M%S") + (f"_{tried}" if tried else "")
        target, tried = new(folder, f"{stamp}_{p.getName()}"), tried + 1
    if not fs.rename(p, target):
        raise OSError(f"{path} was not moved to {folder}")
    return str(target.toString())
