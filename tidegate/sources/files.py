"""Small file-system helpers on the cluster's file system, and the work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Of the tables written: many columns are made of neighbouring numbers, which the default codec hardly shortens.
CODEC = "zstd"


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def listing(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(name, length) of the files that match; empty files included, unlike in a scan."""
    fs, target = _fs(spark, pattern)
    return [
        (status.getPath().getName(), status.getLen())
        for status in fs.globStatus(target) or []
        if status.isFile()
    ]


def make(spark: SparkSession, path: str) -> None:
    """Create a folder."""
    fs, target = _fs(spark, path)
    fs.mkdirs(target)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files and folders that match."""
    fs, target = _fs(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(target) or []]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a file into the place of another one, if there is one, in one step."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    origin, goal = hadoop.Path(source), hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(_fs(spark, target)[0].getUri(), sc._jsc.hadoopConfiguration())
    options = sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(origin, goal, options)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, origin = _fs(spark, source)
    if not fs.rename(origin, _fs(spark, target)[1]):
        raise OSError(f"could not move {source} to {target}")


def write_line(spark: SparkSession, path: str, line: str) -> None:
    """Create a one-line file."""
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(f"{line}\n".encode()))
    finally:
        out.close()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, readable by every executor.

    Lies under ``spark.checkpoint.dir``. Only a local session without that
    setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidegate-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
