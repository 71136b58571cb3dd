"""Landing the event rows as a raw folder, in event-time order or in two
deliveries: the input of the registered streaming queries and of the streaming
tests. All parts are written in one pass beside the raw folder
(``<path>_landing``); a part lands when its files are moved into it."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.timefmt import event_time
from strata.schemas import RAW
from strata.sources.events import events_to_json
from strata.storage import move_files, open_partitions

# Bytes of a row group of landed files, and files that a landing task keeps open.
ROW_GROUP = 8 << 20
OPEN_PARTS = 8
SLICE = "slice"


def land_in_time_order(rows: DataFrame, path: str, n_chunks: int, files: int | None = None) -> Iterator[int]:
    """Append Bronze-shaped rows to a raw folder in ``n_chunks`` event-time
    slices, oldest first, yielding after each slice lands, so a stream
    resumed between slices sees data arrive in time order. Rows without a
    parseable time go first. The rows of all slices are written in one pass, as
    they are scanned, or dealt in turn so that a slice has ``files`` files.
    """
    t = F.unix_micros(event_time("timestamp"))
    lo, hi = rows.agg(F.min(t), F.max(t)).first()
    if lo is None:
        events_to_json(rows).write.mode("append").parquet(path)
        yield 0
        return
    span = hi - lo + 1
    chunk = F.coalesce(F.least(F.floor((t - F.lit(lo)) * F.lit(n_chunks) / F.lit(span)), F.lit(n_chunks - 1)), F.lit(0))
    sliced = rows.withColumn(SLICE, chunk.cast("int"))
    if files:  # file of a slice = partition; the turn is the same on a retried task
        sliced = sliced.repartitionById(n_chunks * files, (F.col(SLICE) * files + F.pmod(F.monotonically_increasing_id(), F.lit(files))).cast("int"))
    _land_parts(events_to_json(sliced, SLICE), path, SLICE)
    for i in range(n_chunks):
        _move_part(rows, path, SLICE, i)
        yield i


def land_deliveries(records: DataFrame, path: str, late: str = "late") -> Iterator[int]:
    """Land ``value`` records as two deliveries in a raw folder, yielding after
    each: one copy of every text that some record not ``late`` has, then all
    the other copies, late records among them.

    Late records are never in the first delivery, so only the others are dealt
    by their text, once, and both deliveries are written in that pass."""
    value = F.col("value")
    copy = F.row_number().over(Window.partitionBy(value).orderBy(value))
    dealt = records.filter(~F.col(late)).select(value, (copy > 1).alias(late))
    dealt = dealt.unionByName(records.filter(late).select(value, late))
    _land_parts(dealt, path, late)
    for part in ("false", "true"):
        _move_part(records, path, late, part)
        yield int(part == "true")


def _landing(path: str) -> str:
    return path.rstrip("/") + "_landing"


def _land_parts(rows: DataFrame, path: str, column: str) -> None:
    """Write rows in one pass beside the raw folder, a folder for each value of
    ``column``. Small row groups let a micro-batch of few files use many tasks."""
    with open_partitions(rows.sparkSession, OPEN_PARTS):
        rows.write.mode("append").option("parquet.block.size", ROW_GROUP).partitionBy(column).parquet(_landing(path))


def _move_part(rows: DataFrame, path: str, column: str, value: object) -> None:
    """Move the files of one value into the raw folder; without any, an empty file."""
    spark = rows.sparkSession
    if not move_files(spark, f"{_landing(path)}/{column}={value}", path, f"{column}-{value}-"):
        spark.createDataFrame([], RAW).write.mode("append").parquet(path)
