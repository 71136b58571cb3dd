"""Folders of tables, through the Hadoop file system API (any store
that Spark reads)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path object) of a folder."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def numbered_folders(spark: SparkSession, root: str, key: str) -> dict[int, str]:
    """``key=<n>`` folders or files directly under ``root`` (listing only)."""
    fs, hroot = hadoop_path(spark, root)
    if not fs.exists(hroot):
        return {}
    out = {}
    for status in fs.listStatus(hroot):
        name, _, number = status.getPath().getName().partition("=")
        if name == key and number.isdigit():
            out[int(number)] = status.getPath().toString()
    return out


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath = hadoop_path(spark, path)
    fs.delete(hpath, True)


def has_flat_files(spark: SparkSession, path: str) -> bool:
    """Whether Parquet files stand directly in a folder, not in partitions (a listing)."""
    fs, root = hadoop_path(spark, path)
    return fs.exists(root) and any(x.getPath().getName().endswith(".parquet") for x in fs.listStatus(root))


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> int:
    """Move the Parquet files of a folder into another, their names with a
    prefix; returns how many there were."""
    fs, hsource = hadoop_path(spark, source)
    if not fs.exists(hsource):
        return 0
    fs.mkdirs(hadoop_path(spark, target)[1])
    names = sorted(s.getPath().getName() for s in fs.listStatus(hsource) if s.getPath().getName().endswith(".parquet"))
    for name in names:
        if not fs.rename(hadoop_path(spark, f"{source}/{name}")[1], hadoop_path(spark, f"{target}/{prefix}{name}")[1]):
            raise OSError(f"could not move {name} from {source} to {target}")
    return len(names)


@contextmanager
def open_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Inside, a task that writes rows of up to ``n`` partitions keeps a file
    open for each and does not sort its rows by partition first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)
