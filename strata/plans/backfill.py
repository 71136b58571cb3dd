"""Batch back-fill of all layers from a raw table (history re-processing).

The same DataFrame functions as the streams, as batch jobs. Each layer is
written to its folder and the next layer reads the written table, so every
step starts from files in shared storage: lineage stays short and a lost
executor only re-runs tasks of the current step.

A back-fill has its own folders: it refuses a layout that a stream writes,
because a file sink's log would go on listing the files that the back-fill
replaced. Every layer is partitioned by event date, and a run replaces the
dates it is given in every layer and no others.

Files a date: rows that stand in no order of dates (parsed records, aggregates)
are dealt by date before they are written, and Spark splits large dates and
joins small ones by size (a rebalance), so files follow the rows of a date and
not the number of tasks. What is derived from a written layer by a filter or a
projection keeps the layout of the files it is read from.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from strata.functions.timefmt import event_time, with_event_time
from strata.operators.bronze import bronze_table, with_flat_metrics
from strata.operators.gold import gold_hourly
from strata.operators.quality import drop_bad_rows, quarantine_rows
from strata.operators.silver import SILVER_FILL, silver_flatten
from strata.schemas import BRONZE_FIELDS, BRONZE_TABLE, EVENT_DATE, PARSED, SILVER_FIELDS, SILVER_TABLE
from strata.sources.tables import read_or_empty
from strata.storage import delete, hadoop_path
from strata.streaming.layers import LayerPaths

DATE = EVENT_DATE
#: Name of the partition that Spark gives to rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _refuse_streamed(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        fs, log = hadoop_path(spark, f"{folder}/_spark_metadata")
        if fs.exists(log):
            raise ValueError(f"{folder} is written by a stream (it has a sink log); back-fill into folders of its own")


def _event_date() -> Column:
    return F.to_date(event_time("timestamp"))


def _replace(df: DataFrame, path: str, by: str, start: str | None, end: str | None, deal: bool) -> None:
    """Write ``df`` over the partitions of the dates from ``start`` to ``end``
    (all of the table without them); dates that no longer have rows go too.

    A range is written beside the table first and then moved into its place
    date by date, so a run that dies while it computes leaves the table as it
    was; one that dies while it moves is repeated."""
    if deal:
        df = df.hint("rebalance", by)
    if start is None and end is None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)
        return
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}_staging/{uuid.uuid4().hex[:12]}"
    df.write.partitionBy(by).parquet(staged)
    new = _dates(spark, staged, by)
    old = {day: folder for day, folder in _dates(spark, path, by).items() if day != NO_DATE and (start or day) <= day <= (end or day)}
    fs, _ = hadoop_path(spark, path)
    for day in sorted({*new, *old}):
        if day in old:
            delete(spark, old[day])
        if day in new:
            fs.mkdirs(hadoop_path(spark, path)[1])
            fs.rename(hadoop_path(spark, new[day])[1], hadoop_path(spark, f"{path}/{by}={day}")[1])
    delete(spark, staged)


def _dates(spark: SparkSession, path: str, by: str) -> dict[str, str]:
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return {}
    folders = [status.getPath() for status in fs.listStatus(root) if status.isDirectory()]
    return {f.getName().split("=", 1)[1]: f.toString() for f in folders if f.getName().startswith(f"{by}=")}


def backfill_layers(
    spark: SparkSession,
    raw: DataFrame,
    paths: LayerPaths,
    rules,
    *,
    drop_bad: bool = False,
    fill: dict | None = SILVER_FILL,
    start_date: str | None = None,
    end_date: str | None = None,
) -> None:
    """raw JSON ``value`` rows -> Bronze -> Silver -> Gold (+ quarantine).

    Without dates the tables are rebuilt whole. With ``start_date`` and/or
    ``end_date`` (ISO, inclusive, event dates) only rows of these dates are
    taken from ``raw`` and only these dates are replaced, in every layer; rows
    whose time does not parse have no date and belong to whole rebuilds alone.
    """
    for day in (start_date, end_date):
        if day is not None:
            dt.date.fromisoformat(day)
    outputs = [paths.bronze, paths.bronze_all, paths.silver, paths.gold, paths.quarantine("bronze"), paths.quarantine("silver")]
    _refuse_streamed(spark, outputs)

    def in_range(df: DataFrame, day: Column) -> DataFrame:
        if start_date is not None:
            df = df.filter(day >= F.lit(start_date).cast("date"))
        if end_date is not None:
            df = df.filter(day <= F.lit(end_date).cast("date"))
        return df

    def replace(df: DataFrame, path: str, by: str = DATE, deal: bool = False) -> None:
        if by == DATE and DATE not in df.columns:
            df = df.withColumn(DATE, _event_date())
        _replace(df, path, by, start_date, end_date, deal)

    def written(path: str, schema: StructType, fields: list[str]) -> DataFrame:
        """The dates of this run, read back with the layer's own columns."""
        dated = StructType([*[f for f in schema.fields if f.name != DATE], StructField(DATE, DateType(), True)])
        return in_range(read_or_empty(spark, path, dated), F.col(DATE)).select(*fields)

    # Parse once: write the parsed rows and the text of those that did not
    # parse, then derive the quarantine (and, with drop_bad, the kept rows)
    # from the written table, where the rule filter is pushed into the scan.
    table = BRONZE_TABLE.fieldNames()
    parsed_path = paths.bronze_all if drop_bad else paths.bronze
    replace(in_range(bronze_table(raw), _event_date()), parsed_path, deal=True)
    flat = with_flat_metrics(written(parsed_path, BRONZE_TABLE, table))
    replace(quarantine_rows(flat.drop(*set(table) - set(BRONZE_FIELDS)), rules), paths.quarantine("bronze"))
    if drop_bad:
        replace(drop_bad_rows(flat, rules).select(*table), paths.bronze)

    events = written(paths.bronze, BRONZE_TABLE, table).filter(PARSED).select(*BRONZE_FIELDS)
    silver = silver_flatten(events, fill)
    replace(with_event_time(drop_bad_rows(silver, rules) if drop_bad else silver), paths.silver)
    silver_written = written(paths.silver, SILVER_TABLE, SILVER_TABLE.fieldNames())
    # Bad rows are not in a drop_bad Silver table: check the flattened input.
    replace(quarantine_rows(silver if drop_bad else silver_written.select(*SILVER_FIELDS), rules), paths.quarantine("silver"))

    replace(gold_hourly(silver_written), paths.gold, "date_hour", deal=True)
