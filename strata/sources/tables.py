"""Batch table readers."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.timefmt import with_event_time
from strata.schemas import BRONZE, BRONZE_TABLE, EVENT_DATE, EVENT_TS, GOLD, PARSED, RAW_TEXT, SILVER_TABLE
from strata.sources.epochs import gold_epochs
from strata.storage import has_flat_files


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None) -> DataFrame:
    """One driver table, e.g. ``read_table(spark, dir, "events", EVENTS)``;
    with a schema, Spark skips reading footers to infer one."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options) -> DataFrame:
    """Read ``path`` with a fixed schema; a path that does not exist yet gives
    an empty DataFrame of that schema instead of an error."""
    try:
        return spark.read.format(fmt).schema(schema).options(**options).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def read_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a layer written by a file sink (or a batch writer), the columns of
    ``schema`` only. Spark honours the sink log, so files of an uncommitted
    batch are never visible."""
    return read_or_empty(spark, path, schema).select(*schema.fieldNames())


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The events of a Bronze table: its records that parsed."""
    return _bronze_table(spark, path).filter(PARSED).select(*BRONZE.fieldNames())


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """``(raw)``: the text of the records of a Bronze table that did not parse.
    They stand in partitions of their own, which no other reader opens."""
    return _bronze_table(spark, path).filter(~F.col(PARSED)).select(RAW_TEXT)


def _bronze_table(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a Bronze table; one without dead letters may lack the column."""
    return read_or_empty(spark, path, BRONZE_TABLE).withColumn(PARSED, F.coalesce(PARSED, F.lit(True)))


def read_silver(spark: SparkSession, path: str, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Silver with its typed event time (``event_ts``) and ``event_date``, the
    partition: a date range opens only the folders of its dates. A table that
    was written without these columns gets them from the text."""
    silver = read_or_empty(spark, path, SILVER_TABLE)
    if has_flat_files(spark, path):
        silver = with_event_time(silver.drop(EVENT_TS, EVENT_DATE))
    return between(silver, EVENT_DATE, start_date, end_date)


def between(df: DataFrame, column: str, start_date: str | None, end_date: str | None) -> DataFrame:
    """Rows whose date lies in the range; an open end has no bound."""
    if start_date:
        df = df.filter(F.col(column) >= F.to_date(F.lit(start_date)))
    if end_date:
        df = df.filter(F.col(column) <= F.to_date(F.lit(end_date)))
    return df


def read_gold(spark: SparkSession, path: str, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Read the final Gold table (partitioned by ``date_hour``), all its epochs
    that hold dates of the range. The range prunes whole partitions before any
    file is opened."""
    some = [e for e in gold_epochs(spark, path) if e.overlaps(start_date, end_date)]
    gold = read_layer(spark, some[0].folder, GOLD) if some else spark.createDataFrame([], GOLD)
    for epoch in some[1:]:
        gold = gold.unionByName(read_layer(spark, epoch.folder, GOLD))
    return between(gold, "date_hour", start_date, end_date)


def read_gold_closed(spark: SparkSession, paths, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """The closed hours of Gold: those that the stream emitted, but where an
    hour was repaired (:mod:`strata.streaming.repair`) its newest correction."""
    from strata.streaming.versions import HOUR, hours_in_force, read_hours

    emitted = read_gold(spark, paths.gold, start_date, end_date)
    hours = hours_in_force(spark, paths.gold_corrections)
    kept = emitted.join(hours, [emitted[c] == hours[c] for c in HOUR], "left_anti")
    return kept.unionByName(between(read_hours(spark, paths.gold_corrections, GOLD), "date_hour", start_date, end_date))


def newest_closed(gold: DataFrame) -> tuple | None:
    """(date, hour) of the newest hour of a Gold table: its newest partition, then that partition's hours."""
    date = gold.agg(F.max("date_hour").alias("d")).first()["d"]
    if date is None:
        return None
    return date, gold.filter(F.col("date_hour") == F.lit(date)).agg(F.max("hour").alias("h")).first()["h"]


def hour_end(date, hour: int) -> Column:
    """When the hour ends."""
    return F.lit(date).cast("timestamp") + F.make_dt_interval(hours=F.lit(hour + 1))


def read_gold_current(spark: SparkSession, paths, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Every hour of Gold: the closed hours, repaired ones as corrected, and the
    hours that the watermark has not closed yet from Silver.

    The final table holds all windows up to its newest hour (append mode emits
    windows in the order in which the watermark passes their end), so the
    open hours are those after it. Only that one hour reaches the driver; it
    and the date range are partition filters on Silver."""
    from strata.operators.gold import gold_hourly

    newest = newest_closed(read_gold(spark, paths.gold))
    open_rows = read_silver(spark, paths.silver, start_date, end_date)
    if newest is not None:
        open_rows = open_rows.filter((F.col(EVENT_DATE) >= F.lit(newest[0])) & (F.col(EVENT_TS) >= hour_end(*newest)))
    closed = read_gold_closed(spark, paths, start_date, end_date)
    # A window lies in one date, so the bounds on Silver rows are those of the hours.
    return closed.unionByName(gold_hourly(open_rows))


def read_gold_live(spark: SparkSession, path: str, snapshot: str | None = None) -> DataFrame:
    """Current Gold rows from the live (update-mode) table; with the
    ``snapshot`` table of :mod:`strata.streaming.compaction`, from the
    snapshot plus the batches not yet folded into it."""
    if snapshot:
        from strata.streaming.compaction import read_live_current

        return read_live_current(spark, path, snapshot)
    from strata.operators.gold import gold_latest
    from strata.schemas import GOLD_LIVE

    return gold_latest(read_layer(spark, path, GOLD_LIVE))


def read_quarantine(spark: SparkSession, root: str, layers: tuple[str, ...] = ("bronze", "silver")) -> dict[str, DataFrame]:
    """Quarantine tables per layer (each with its own schema: Bronze rows
    keep their structs). A layer with nothing quarantined yet is empty."""
    from strata.schemas import QUARANTINE

    return {layer: read_or_empty(spark, os.path.join(root, layer), QUARANTINE[layer]) for layer in layers}
