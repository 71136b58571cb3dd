"""Tables of whole event hours that are replaced under their readers.

    <root>/date_hour=<d>/hour=<h>/version=<n>/    rows; a folder never changes
    <root>_versions/<n>=<mark>/                   (date_hour, hour, version): where
                                                  each hour stands after run n

A run writes the hours it replaces as a new version and then the list of where
every hour stands. That list is in force once its ``_SUCCESS`` file exists: the
creation of one file is the switch, on any store. A reader resolves the newest
list and opens only the folders in it, so a run beside it neither removes nor
adds anything that the reader sees. Superseded folders go once the list that
replaced them is ``grace`` seconds old; a reader that takes longer than that
must read again.

One writer at a time. A run that dies leaves folders that no list names; its
number is not used again, and the next run deletes them. The lists are as long
as there are hours, whatever the number of rows.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from strata.sources.tables import read_or_empty
from strata.streaming.folders import delete, hadoop_path

HOUR = ("date_hour", "hour")
_VERSION = StructField("version", LongType(), True)
HOURS = StructType([StructField("date_hour", DateType(), True), StructField("hour", IntegerType(), True)])
LIST = StructType([*HOURS.fields, _VERSION])


@dataclass(frozen=True)
class Published:
    """A list of hours in force: its run, what the run's caller noted, since when."""

    version: int
    mark: int
    folder: str
    since: float


def lists_root(root: str) -> str:
    return root.rstrip("/") + "_versions"


def _runs(spark: SparkSession, root: str) -> dict[int, Published | None]:
    """Every run by its number; None for one that has not published (a listing, no job)."""
    fs, hroot = hadoop_path(spark, lists_root(root))
    out: dict[int, Published | None] = {}
    if not fs.exists(hroot):
        return out
    for status in fs.listStatus(hroot):
        number, _, mark = status.getPath().getName().partition("=")
        if number.isdigit():
            folder = status.getPath().toString()
            _, done = hadoop_path(spark, f"{folder}/_SUCCESS")
            published = fs.exists(done)
            out[int(number)] = Published(int(number), int(mark), folder, fs.getFileStatus(done).getModificationTime() / 1000) if published else None
    return out


def published(spark: SparkSession, root: str) -> Published | None:
    """The list in force."""
    return max((r for r in _runs(spark, root).values() if r), key=lambda r: r.version, default=None)


def _listed(spark: SparkSession, run: Published | None) -> DataFrame:
    return spark.read.schema(LIST).parquet(run.folder) if run else spark.createDataFrame([], LIST)


def _same_hour(a: DataFrame, b: DataFrame):
    return (a["date_hour"] == b["date_hour"]) & (a["hour"] == b["hour"])


def read_hours(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The rows in force. The list becomes one flat filter on the partition
    columns, so superseded folders are pruned before anything is opened, as are
    hours that a further filter excludes. The list itself reaches the driver."""
    run = published(spark, root)
    if run is None:
        return spark.createDataFrame([], schema)
    rows = read_or_empty(spark, root, StructType([*schema.fields, _VERSION]))
    stands = [f"'{r['date_hour']}/{r['hour']}/{r['version']}'" for r in _listed(spark, run).collect()]
    if not stands:
        return spark.createDataFrame([], schema)
    return rows.filter(f"concat_ws('/', date_hour, hour, version) IN ({', '.join(stands)})").select(*schema.fieldNames())


def hours_in_force(spark: SparkSession, root: str) -> DataFrame:
    """``(date_hour, hour)`` of the list in force, also hours without rows."""
    return _listed(spark, published(spark, root)).select(*HOUR)


def replace_hours(spark: SparkSession, root: str, rows: DataFrame, hours: DataFrame, mark: int = 0) -> int:
    """Put ``rows`` in the place of all rows of ``hours`` (date_hour, hour) and
    publish; returns the run's number. ``rows`` holds rows of these hours only;
    an hour without any is empty from now on. ``mark`` is the caller's note."""
    runs = _runs(spark, root)
    run = max(runs, default=-1) + 1
    newest = max((r for r in runs.values() if r), key=lambda r: r.version, default=None)
    folder = f"{lists_root(root)}/{run}={mark}"
    fs, hfolder = hadoop_path(spark, folder)
    fs.mkdirs(hfolder)  # takes the number, also for a run that dies
    rows.withColumn("version", F.lit(run).cast("long")).write.mode("append").partitionBy(*HOUR, "version").parquet(root)
    old, new = _listed(spark, newest), hours.select(*HOUR).distinct()
    stands = old.join(new, _same_hour(old, new), "left_anti").unionByName(new.withColumn("version", F.lit(run).cast("long")))
    stands.coalesce(1).write.mode("append").parquet(folder)
    return run


def sweep(spark: SparkSession, root: str, grace: float = 0.0) -> int:
    """Delete the folders that were superseded at least ``grace`` seconds ago
    and those of runs that died; returns the newest mark whose list is that old
    (-1 without one). Not beside a run."""
    now = time.time()
    runs = _runs(spark, root)
    lists = sorted((r for r in runs.values() if r), key=lambda r: r.version)
    fs, _ = hadoop_path(spark, root)
    for number, run in runs.items():
        if run is None:
            left = fs.globStatus(hadoop_path(spark, f"{root}/*/*/version={number}")[1])
            for status in left or []:
                delete(spark, status.getPath().toString())
    for old, new in zip(lists, lists[1:], strict=False):
        if now - new.since < grace:
            break
        was, stays = _listed(spark, old), _listed(spark, new)
        for r in was.join(stays, _same_hour(was, stays) & (was["version"] == stays["version"]), "left_anti").toLocalIterator():
            delete(spark, f"{root}/date_hour={r['date_hour']}/hour={r['hour']}/version={r['version']}")
        delete(spark, old.folder)
    return max((r.mark for r in lists if now - r.since >= grace), default=-1)
