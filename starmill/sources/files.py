"""File life-cycle through the Hadoop file-system API, so that any store Spark reads will do."""

from __future__ import annotations

import posixpath
from datetime import datetime, timedelta
from time import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def matching(spark: SparkSession, path: str) -> list[str]:
    """The files and folders that a path or glob names."""
    fs, hadoop_path = _fs(spark, path)
    return sorted(s.getPath().toString() for s in fs.globStatus(hadoop_path) or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(matching(spark, path))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, hadoop_source = _fs(spark, source)
    _, hadoop_target = _fs(spark, target)
    if fs.exists(hadoop_target) or not fs.rename(hadoop_source, hadoop_target):
        raise OSError(f"cannot move {source} to {target}")


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def read_small_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write a file; without ``overwrite`` only if there is none, which of two writers one is told."""
    fs, hadoop_path = _fs(spark, path)
    try:
        stream = fs.create(hadoop_path, overwrite)
    except Py4JJavaError as error:
        if fs.exists(hadoop_path):
            raise FileExistsError(path) from error
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def age(spark: SparkSession, path: str) -> timedelta | None:
    """Time since a file was written; None if there is none."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return None
    return timedelta(seconds=time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000)


def archive_name(path: str, at: datetime) -> str:
    stem, suffix = posixpath.splitext(posixpath.basename(path))
    return f"{stem}_{at:%Y%m%d_%H%M%S}{suffix}"


def archive_file(spark: SparkSession, path: str, archive_dir: str, at: datetime) -> str:
    """Move a loaded file to the archive under a time-stamped name."""
    make_folder(spark, archive_dir)
    target = posixpath.join(archive_dir, archive_name(path, at))
    move(spark, path, target)
    return target
