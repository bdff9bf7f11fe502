"""File-system calls on whatever storage a path names."""

from __future__ import annotations

import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str) -> tuple[Any, Any]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute form of ``path``, so that all users of it mean the same place."""
    hadoop_path, fs = _hadoop(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def total_bytes(spark: SparkSession, path: str) -> int:
    hadoop_path, fs = _hadoop(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path``; none if it is missing."""
    hadoop_path, fs = _hadoop(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(entry.getPath().getName() for entry in fs.listStatus(hadoop_path))


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def delete_empty(spark: SparkSession, path: str) -> None:
    """Delete a folder unless something lies in it."""
    hadoop_path, fs = _hadoop(spark, path)
    if fs.exists(hadoop_path) and not fs.listStatus(hadoop_path):
        fs.delete(hadoop_path, False)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the data files of a folder into another one and delete the folder.

    If one cannot be moved, those moved before it go back to where they were.
    """
    source_path, fs = _hadoop(spark, source)
    target_path, _ = _hadoop(spark, target)
    fs.mkdirs(target_path)
    path, moved = spark._jvm.org.apache.hadoop.fs.Path, []
    for name in (n for n in names_below(spark, source) if n[0] not in "_."):
        old, new = path(source_path, name), path(target_path, name)
        if not fs.rename(old, new):
            for back, there in reversed(moved):
                fs.rename(there, back)
            raise OSError(f"cannot move {old} to {target}")
        moved.append((old, new))
    fs.delete(source_path, True)


def make_temporary(spark: SparkSession, path: str) -> None:
    """Create a folder that goes away when the driver exits."""
    hadoop_path, fs = _hadoop(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path, fs = _hadoop(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist. Readers see all of it or nothing.

    It is written under another name and renamed without overwriting, which a shared file
    system does atomically, so of two writers one fails. Renaming local files checks first
    and overwrites then, and moves their checksum apart: there the name is a hard link.
    """
    jvm = spark._jvm
    hadoop_path, fs = _hadoop(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f"_{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.getUri().getScheme() == "file":
        path_of = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
        try:
            jvm.java.nio.file.Files.createLink(path_of(hadoop_path), path_of(draft))
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            raise Py4JJavaError(f"{path} exists", error.java_exception) from error
        finally:
            fs.delete(draft, False)
        return
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, hadoop_path, no_options)
    except Exception:
        fs.delete(draft, False)
        raise
