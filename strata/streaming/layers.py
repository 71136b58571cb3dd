"""The layer jobs as Structured Streaming queries.

* Bronze: raw JSON stream -> parsed events -> Parquet file sink; the text of
  records that did not parse goes to a partition of its own in the same
  commit. Its quarantine query reads the committed Bronze files (JSON is
  parsed once).
* Silver: Bronze file stream -> flattened, filled rows with a typed event
  time -> file sink partitioned by event date; its quarantine query reads the
  committed Silver files, where the rules are plain comparisons on flat
  columns that reach the Parquet scan.
* Gold, final form: Silver file stream -> hourly windows with a watermark ->
  append-mode file sink partitioned by ``date_hour``; each window is written
  once, after the watermark passes its end.
* Gold, live form: the same aggregate in update mode; every micro-batch
  writes the changed keys' cumulative rows into its own ``batch_id``
  partition (dynamic overwrite, so a replayed batch replaces itself). Read
  it through :func:`strata.operators.gold.gold_latest`.

File sinks keep a sink log next to the data, so the rows of a batch that
was replayed after a failure are never visible twice to Spark readers or to
the next layer's file stream. Counts for the metric lines are gathered with
``observe`` in the same pass that writes the layer. Failures are not
swallowed: the caller records an error line and the exception propagates.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from strata.functions.timefmt import with_event_time
from strata.operators.bronze import bronze_table, with_flat_metrics
from strata.operators.gold import gold_hourly
from strata.operators.quality import drop_bad_rows, id_sketch, quality_counts, quarantine_rows, validate_schema
from strata.operators.silver import SILVER_FILL, silver_flatten
from strata.schemas import BRONZE, BRONZE_TABLE, EVENT_DATE, EVENT_TS, PARSED, SILVER, SILVER_TABLE
from strata.session import use_utc
from strata.sources.epochs import epochs_root, gold_epochs
from strata.sources.raw import ANY_AGE
from strata.storage import has_flat_files
from strata.streaming.folders import hadoop_path, mark_done
from strata.streaming.metrics_sink import FIRST, MetricsListener, error_metric, query_metrics, write_batch_metrics

DEFAULT_WATERMARK = "25 hours"


@dataclass(frozen=True)
class LayerPaths:
    """Folder layout of one deployment under a shared root."""

    root: str

    def _p(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    @property
    def bronze(self) -> str:
        return self._p("bronze")

    @property
    def bronze_all(self) -> str:
        return self._p("_staging", "bronze_all")

    @property
    def silver(self) -> str:
        return self._p("silver")

    @property
    def gold(self) -> str:
        return self._p("gold", "fact_events_hourly")

    @property
    def gold_corrections(self) -> str:
        return self._p("gold", "fact_events_hourly_corrections")

    @property
    def gold_live(self) -> str:
        return self._p("gold", "fact_events_hourly_live")

    @property
    def gold_live_snapshot(self) -> str:
        return self._p("gold", "fact_events_hourly_live_snapshot")

    def quarantine(self, layer: str) -> str:
        return self._p("quarantine", layer)

    @property
    def metrics(self) -> str:
        return self._p("metrics")

    def checkpoint(self, name: str) -> str:
        return self._p("checkpoints", name)


#: Output folders and checkpoints of each layer, for :func:`reset_layer`.
def _layer_folders(paths: LayerPaths, layer: str) -> tuple[list[str], list[str]]:
    outputs = {
        "bronze": [paths.bronze, paths.bronze_all, paths.quarantine("bronze")],
        "silver": [paths.silver, paths.quarantine("silver")],
        "gold": [paths.gold, epochs_root(paths.gold), paths.gold_corrections, paths.gold_corrections + "_versions"],
        "gold_live": [
            paths.gold_live, paths.gold_live_snapshot, paths.gold_live_snapshot + "_versions", paths.gold_live_snapshot + "_staging", paths.gold_live + "_done",
        ],
    }
    checkpoints = {
        "bronze": ["bronze", "bronze_all", "bronze_quarantine", "bronze_duplicates"],
        "silver": ["silver", "silver_quarantine", "silver_duplicates"],
        "gold": ["gold_final"],
        "gold_live": ["gold_live"],
    }
    return outputs[layer], [paths.checkpoint(c) for c in checkpoints[layer]]


def gold_checkpoint(paths: LayerPaths, epoch: int) -> str:
    return paths.checkpoint(f"gold_final_{epoch}" if epoch else "gold_final")


# A layer's output is the next one's input, so a reset goes on downstream.
DOWNSTREAM = {"bronze": ("bronze", "silver", "gold", "gold_live"), "silver": ("silver", "gold", "gold_live"), "gold": ("gold",), "gold_live": ("gold_live",)}


def reset_layer(spark: SparkSession, paths: LayerPaths, layer: str) -> list[str]:
    """Delete a layer's output, sink log and checkpoint together, and those of
    every layer built from it, so that the next run rebuilds them all from the
    input. Returns the folders deleted. Stop the layer queries first.

    Deleting a checkpoint alone loses rows: batch numbers start again and the
    sink skips every number that its log already has."""
    gone = []
    for one in DOWNSTREAM[layer]:
        outputs, checkpoints = _layer_folders(paths, one)
        if one == "gold":
            checkpoints += [gold_checkpoint(paths, e.number) for e in gold_epochs(spark, paths.gold)[1:]]
        for folder in outputs + checkpoints:
            fs, hpath = hadoop_path(spark, folder)
            if fs.exists(hpath):
                fs.delete(hpath, True)
                gone.append(folder)
    return gone


def _newest_number(spark: SparkSession, folder: str) -> int:
    """Largest batch number among the files of a log folder; -1 without any."""
    fs, hpath = hadoop_path(spark, folder)
    if not fs.exists(hpath):
        return -1
    names = [status.getPath().getName().split(".")[0] for status in fs.listStatus(hpath)]
    return max((int(n) for n in names if n.isdigit()), default=-1)


def check_sink(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Raise if the sink log at ``path`` is ahead of the checkpoint by more
    than the one batch a failure can leave uncommitted: the sink would skip
    the next batches and their rows would be lost."""
    logged, committed = _newest_number(spark, f"{path}/_spark_metadata"), _newest_number(spark, f"{checkpoint}/commits")
    planned = _newest_number(spark, f"{checkpoint}/offsets")
    if logged > max(committed, planned):
        raise RuntimeError(
            f"{path} holds batches up to {logged}, its checkpoint {checkpoint} only up to {max(committed, planned)}: "
            "restore the checkpoint or call reset_layer"
        )


def _check_live(spark: SparkSession, paths: LayerPaths) -> None:
    """As :func:`check_sink` for live Gold, whose versions are batch numbers."""
    if _newest_number(spark, f"{paths.checkpoint('gold_live')}/offsets") >= 0:
        return
    for folder in (paths.gold_live, paths.gold_live_snapshot):
        fs, hpath = hadoop_path(spark, folder)
        if fs.exists(hpath):
            raise RuntimeError(f"{folder} was written under a checkpoint that is gone: its batch numbers would clash; restore it or call reset_layer")


def _trigger(writer: DataStreamWriter, trigger: dict | None) -> DataStreamWriter:
    return writer.trigger(**(trigger or {"availableNow": True}))


def _file_sink(df: DataFrame, path: str, checkpoint: str, name: str, trigger: dict | None, partition_by=None):
    check_sink(df.sparkSession, path, checkpoint)
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .queryName(name)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, trigger).start()


def _observed(df: DataFrame, name: str, rules, *more) -> DataFrame:
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *quality_counts(df, rules), *more)


def _sketch(wanted: bool) -> list:
    return [id_sketch().alias("event_ids")] if wanted else []


def _keep(df: DataFrame, rules, drop_bad: bool) -> DataFrame:
    return drop_bad_rows(df, rules) if drop_bad else df


def duplicate_stream(
    df: DataFrame, paths: LayerPaths, layer: str, trigger: dict | None = None, id_field: str = "event_id"
) -> StreamingQuery:
    """Per micro-batch exact duplicate count (rows minus distinct ids), as a
    ``<layer>_duplicates`` metric line whose ``extra`` holds the count.
    Exact distinct counting is not available in ``observe`` or a streaming
    aggregate, so this is a separate query over the same input; a replayed
    batch may write its line twice (the count itself is unchanged)."""
    from strata.operators.quality import duplicate_count
    from strata.streaming.metrics_sink import write_batch_metrics as write

    def check(batch: DataFrame, batch_id: int) -> None:
        r = duplicate_count(batch, id_field).first()
        if r.total:
            line = (int(time.time()), f"{layer}_duplicates", batch_id, int(r.total), None, {"duplicates": str(r.duplicates)})
            write(batch.sparkSession, [line], paths.metrics)

    writer = (
        df.select(id_field)
        .writeStream.foreachBatch(check)
        .option("checkpointLocation", paths.checkpoint(f"{layer}_duplicates"))
        .queryName(f"{layer}_duplicates")
    )
    return _trigger(writer, trigger).start()


def keyed_duplicate_stream(
    df: DataFrame, paths: LayerPaths, layer: str, horizon: str, trigger: dict | None = None, id_field: str = "event_id"
) -> StreamingQuery:
    """Exact duplicate count across micro-batches, as a ``<layer>_duplicates``
    metric line: rows minus ids not seen within ``horizon`` (NULL ids count as
    duplicates, as in :func:`strata.operators.quality.duplicate_count`).

    The ids seen are keyed state. They expire by arrival, not by event time: a
    record that is delivered again comes soon after the first, whatever time it
    carries, and a record without a time counts as well. State and shuffle hold
    ids only; counts come from ``observe``, and a replayed batch counts alike."""
    name = f"{layer}_duplicates"
    rows = F.count(F.lit(1)).alias("rows")
    ids = df.select(F.col(id_field).alias("id"), F.current_timestamp().alias("arrived")).observe(name, rows)
    first = ids.filter("id IS NOT NULL").withWatermark("arrived", horizon).dropDuplicatesWithinWatermark(["id"]).observe(name + FIRST, rows)
    writer = first.writeStream.format("noop").outputMode("append").option("checkpointLocation", paths.checkpoint(name)).queryName(name)
    return _trigger(writer, trigger).start()


def _duplicate_queries(
    spark, paths, layer, folder, per_batch: bool, horizon: str | None, trigger, max_files, state_partitions, rocksdb, listener=None
) -> list[tuple[str, StreamingQuery, str | None]]:
    """The duplicate count of a layer that was asked for, as (layer, query, observation)."""
    name = f"{layer}_duplicates"
    if horizon:
        own = _stateful_session(spark, state_partitions, rocksdb, no_data_batches=False)
        if listener:
            own.streams.addListener(listener)
        return [(name, keyed_duplicate_stream(_read_bronze_stream(own, folder, max_files), paths, layer, horizon, trigger), name)]
    if per_batch:
        return [(name, duplicate_stream(_read_bronze_stream(spark, folder, max_files), paths, layer, trigger), None)]
    return []


def _check_schema(df: DataFrame, fields: list[str], fail_on_schema: bool) -> None:
    """Field names against the layer's; a missing one is logged or raised."""
    if not validate_schema(df, fields) and fail_on_schema:
        raise ValueError(f"schema check failed: expected fields {fields}, got {df.columns}")


def bronze_stream(
    raw: DataFrame, paths: LayerPaths, rules, trigger: dict | None = None, drop_bad: bool = False, fail_on_schema: bool = False,
    distinct_sketches: bool = False,
) -> list[StreamingQuery]:
    """Start the query that parses the source, the only one that reads it: JSON
    is parsed once, and no row can fall between two reads of a live source.

    It writes Bronze; with ``drop_bad`` it writes all parsed rows to a staging
    table, from which :func:`bronze_split_streams` derives Bronze and its
    quarantine. Records of which nothing could be read go to the same table's
    partition ``parsed=false`` with their text, so they are committed with the
    batch that read them; the metric line counts them (``dead_letters``)."""
    parsed = bronze_table(raw)
    _check_schema(parsed.drop(*set(BRONZE_TABLE.fieldNames()) - set(BRONZE.fieldNames())), BRONZE.fieldNames(), fail_on_schema)
    # Observe on the flattened projection so the rule counts see the metric
    # columns (and every row), then write only the Bronze columns.
    more = [F.count_if(~F.col(PARSED)).alias("dead_letters"), *_sketch(distinct_sketches)]
    written = _observed(with_flat_metrics(parsed), "bronze", rules, *more).select(*BRONZE_TABLE.fieldNames())
    path, name = (paths.bronze_all, "bronze_all") if drop_bad else (paths.bronze, "bronze")
    return [_file_sink(written, path, paths.checkpoint(name), "bronze", trigger, [PARSED])]


def bronze_split_streams(
    spark: SparkSession, paths: LayerPaths, rules, trigger: dict | None = None, drop_bad: bool = False, max_files: int | None = None
) -> list[StreamingQuery]:
    """Bronze quarantine from the committed parsed rows and, with ``drop_bad``,
    Bronze itself (the rows that break no rule)."""
    path = paths.bronze_all if drop_bad else paths.bronze
    queries = [_bronze_quarantine_sink(with_flat_metrics(_read_bronze_stream(spark, path, max_files)), paths, rules, trigger)]
    if drop_bad:  # dead letters break no rule and go on
        table = with_flat_metrics(_read_layer_stream(spark, path, BRONZE_TABLE, max_files, None))
        kept = drop_bad_rows(table, rules).select(*BRONZE_TABLE.fieldNames())
        queries.append(_file_sink(kept, paths.bronze, paths.checkpoint("bronze"), "bronze_kept", trigger, [PARSED]))
    return queries


def _bronze_quarantine_sink(flat: DataFrame, paths: LayerPaths, rules, trigger: dict | None) -> StreamingQuery:
    return _file_sink(
        quarantine_rows(flat, rules),
        paths.quarantine("bronze"),
        paths.checkpoint("bronze_quarantine"),
        "bronze_quarantine",
        trigger,
    )


def _read_layer_stream(spark: SparkSession, path: str, schema, max_files: int | None, max_file_age: str | None):
    reader = spark.readStream.format("parquet").schema(schema).option("maxFileAge", max_file_age or ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _read_bronze_stream(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    """The events of a Bronze table (the filter prunes the dead letters' folders)."""
    table = _read_layer_stream(spark, path, BRONZE_TABLE, max_files, None)
    return table.filter(F.coalesce(PARSED, F.lit(True))).select(*BRONZE.fieldNames())


def silver_stream(
    spark: SparkSession,
    paths: LayerPaths,
    rules,
    trigger: dict | None = None,
    max_files: int | None = None,
    fill: dict | None = SILVER_FILL,
    drop_bad: bool = False,
    fail_on_schema: bool = False,
    distinct_sketches: bool = False,
) -> list[StreamingQuery]:
    """Start the Silver write. With ``drop_bad`` the Silver quarantine query
    is started here too, over the Bronze stream (the dropped rows never reach
    Silver); otherwise it runs later over the written Silver files
    (:func:`silver_quarantine_stream`)."""
    silver = silver_flatten(_read_bronze_stream(spark, paths.bronze, max_files), fill)
    _check_schema(silver, SILVER.fieldNames(), fail_on_schema)
    main = _file_sink(
        with_event_time(_keep(_observed(silver, "silver", rules, *_sketch(distinct_sketches)), rules, drop_bad)),
        paths.silver,
        paths.checkpoint("silver"),
        "silver",
        trigger,
        [EVENT_DATE],
    )
    if not drop_bad:
        return [main]
    return [main, _silver_quarantine_sink(silver, paths, rules, trigger)]


def _silver_quarantine_sink(silver: DataFrame, paths: LayerPaths, rules, trigger: dict | None) -> StreamingQuery:
    return _file_sink(
        quarantine_rows(silver, rules),
        paths.quarantine("silver"),
        paths.checkpoint("silver_quarantine"),
        "silver_quarantine",
        trigger,
    )


def silver_quarantine_stream(
    spark: SparkSession, paths: LayerPaths, rules, trigger: dict | None = None, max_files: int | None = None
) -> StreamingQuery:
    """Silver quarantine from the committed Silver files. Silver columns are
    flat and filled, so the any-rule filter is pushed to the Parquet scan
    and row groups whose min/max lie inside every range are skipped."""
    silver = _read_layer_stream(spark, paths.silver, SILVER_TABLE, max_files, None).select(*SILVER.fieldNames())
    return _silver_quarantine_sink(silver, paths, rules, trigger)


def _gold_input(spark, paths, watermark, max_files, max_file_age, name, start: int | None = None):
    silver = _read_layer_stream(spark, paths.silver, SILVER_TABLE, max_files, max_file_age)
    if has_flat_files(spark, paths.silver):  # written without the typed time
        silver = silver.drop(EVENT_TS, EVENT_DATE)
    if start is not None:  # the hours of an epoch; the date prunes the folders before
        at = F.timestamp_seconds(F.lit(start))
        silver = with_event_time(silver).filter((F.col(EVENT_DATE) >= F.to_date(at)) & (F.col(EVENT_TS) >= at))
    # Count the rows each batch emits (observed after the aggregate).
    return gold_hourly(silver, watermark=watermark).observe(name, F.count(F.lit(1)).alias("rows"))


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _stateful_session(spark: SparkSession, state_partitions: int | None, rocksdb: bool, no_data_batches: bool = True) -> SparkSession:
    """A session of its own for a stateful query, with the caller's settings and
    those of its state, which the first run records in the checkpoint:
    ``state_partitions`` shuffle/state partitions (size them to the keys alive
    within the watermark horizon, not to the session default) and, with
    ``rocksdb``, state kept in RocksDB off the JVM heap with changelog
    checkpointing (for large state). ``no_data_batches=False`` skips the extra
    batch Spark runs only to advance the watermark. The caller's session keeps
    its settings, also while the query starts."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    use_utc(own)
    if not no_data_batches:
        own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    if rocksdb:
        own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return own


def gold_final_stream(
    spark: SparkSession,
    paths: LayerPaths,
    watermark: str = DEFAULT_WATERMARK,
    trigger: dict | None = None,
    max_files: int | None = None,
    max_file_age: str | None = None,
    state_partitions: int | None = None,
    rocksdb: bool = False,
    output_files: int | None = None,
    listener: MetricsListener | None = None,
) -> StreamingQuery:
    """Append-mode Gold: one row per key, written once its window closes. It
    goes on in the table's newest epoch (:mod:`strata.streaming.epochs`).

    Without ``output_files`` every state partition writes its own file into
    each ``date_hour`` an emission touches; with hundreds of state
    partitions that is hundreds of small files per closed hour. With it, the
    emitted rows alone (not the input) are round-robined over that many
    tasks before the sink, so each emission writes at most ``output_files``
    files per date."""
    own = _stateful_session(spark, state_partitions, rocksdb)
    if listener:
        own.streams.addListener(listener)
    epoch = gold_epochs(spark, paths.gold)[-1]
    gold = _gold_input(own, paths, watermark, max_files, max_file_age, "gold", epoch.start)
    if output_files:
        gold = gold.repartition(output_files)
    return _file_sink(gold, epoch.folder, gold_checkpoint(paths, epoch.number), "gold_final", trigger, ["date_hour"])


def _live_writer(path: str, output_files: int | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        if output_files:
            batch = batch.repartition(output_files)
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )
        mark_done(batch.sparkSession, path, batch_id)

    return write


def gold_live_stream(
    spark: SparkSession,
    paths: LayerPaths,
    watermark: str | None = DEFAULT_WATERMARK,
    trigger: dict | None = None,
    max_files: int | None = None,
    max_file_age: str | None = None,
    state_partitions: int | None = None,
    rocksdb: bool = False,
    output_files: int | None = None,
    listener: MetricsListener | None = None,
) -> StreamingQuery:
    """Update-mode Gold: changed keys' cumulative rows, tagged by batch
    (``output_files`` as in :func:`gold_final_stream`)."""
    _check_live(spark, paths)
    # Update mode emits nothing in a batch without input (it would only
    # evict expired state, which the next data batch does as well).
    own = _stateful_session(spark, state_partitions, rocksdb, no_data_batches=False)
    if listener:
        own.streams.addListener(listener)
    gold = _gold_input(own, paths, watermark, max_files, max_file_age, "gold_live")
    writer = (
        gold.writeStream.outputMode("update")
        .option("checkpointLocation", paths.checkpoint("gold_live"))
        .queryName("gold_live")
        .foreachBatch(_live_writer(paths.gold_live, output_files))
    )
    return _trigger(writer, trigger).start()


def await_layers(
    spark: SparkSession,
    paths: LayerPaths,
    layer_queries: list[tuple[str, StreamingQuery, str | None]],
    poll_seconds: float = 0.2,
    sink: list[tuple] | None = None,
):
    """Wait for a group of queries, gathering every batch's progress while
    they run (Spark keeps only the most recent updates), then write one
    metric line per committed batch, also of a group that fails. On failure:
    stop the group, write an error line with the number of the failed batch
    and re-raise."""
    progress: dict[str, dict[int, object]] = {str(q.id): {} for _, q, _ in layer_queries}
    rows: list[tuple] = []

    def drain(q: StreamingQuery) -> None:
        for p in q.recentProgress:
            progress[str(q.id)][p.batchId] = p

    pending = list(layer_queries)
    try:
        while pending:
            for entry in list(pending):
                layer, query, _ = entry
                try:
                    done = query.awaitTermination(poll_seconds)
                except Exception as exc:  # record, then propagate
                    drain(query)
                    rows.append(error_metric(layer, max(progress[str(query.id)], default=-1) + 1, exc))
                    raise
                drain(query)
                if done:
                    pending.remove(entry)
    finally:
        for layer, query, observation in layer_queries:
            if query.isActive:
                query.stop()
            drain(query)
            if observation or not layer.endswith(("_quarantine", "_duplicates", "_kept")):
                batches = [progress[str(query.id)][b] for b in sorted(progress[str(query.id)])]
                rows.extend(query_metrics(layer, batches, observation))
        if sink is None:
            write_batch_metrics(spark, rows, paths.metrics)
        else:
            sink.extend(rows)


def run_layers(
    spark: SparkSession,
    raw: DataFrame,
    paths: LayerPaths,
    rules,
    *,
    gold_modes: tuple[str, ...] = ("final",),
    watermark: str = DEFAULT_WATERMARK,
    max_files: int | None = None,
    state_partitions: int | None = None,
    rocksdb: bool = False,
    drop_bad: bool = False,
    duplicate_metrics: bool = False,
    duplicate_horizon: str | None = None,
    distinct_sketches: bool = False,
    output_files: int | None = None,
    fail_on_schema: bool = False,
) -> None:
    """Run every layer once over all available input (``availableNow``),
    layer after layer, and write their metric lines as one file. Re-running
    with the same folders resumes from the checkpoints and processes only new
    input. With ``duplicate_metrics`` each Bronze and Silver batch also gets an
    exact duplicate count (one more query per layer); with ``duplicate_horizon``
    (e.g. ``"24 hours"``) the count goes across batches
    (:func:`keyed_duplicate_stream`). With ``distinct_sketches`` their metric
    lines carry a mergeable sketch of the batch's ids. With ``fail_on_schema`` a
    layer whose input lacks a field raises instead of logging it.
    """
    lines: list[tuple] = []
    try:
        checks = dict(fail_on_schema=fail_on_schema, distinct_sketches=distinct_sketches)
        bronze = [("bronze", q, "bronze") for q in bronze_stream(raw, paths, rules, drop_bad=drop_bad, **checks)]
        await_layers(spark, paths, bronze, sink=lines)
        # The quarantine, duplicates and, with drop_bad, Bronze itself read the table just written.
        split = bronze_split_streams(spark, paths, rules, drop_bad=drop_bad, max_files=max_files)
        beside = [("bronze_quarantine", split[0], None)]

        def duplicates(layer: str, folder: str) -> list:
            return _duplicate_queries(spark, paths, layer, folder, duplicate_metrics, duplicate_horizon, None, max_files, state_partitions, rocksdb)

        beside += duplicates("bronze", paths.bronze_all if drop_bad else paths.bronze)
        if drop_bad:
            await_layers(spark, paths, [*beside, ("bronze_kept", split[1], None)], sink=lines)
            beside = []
        silver = _named("silver", silver_stream(spark, paths, rules, max_files=max_files, drop_bad=drop_bad, **checks)) + beside
        silver += duplicates("silver", paths.bronze)
        await_layers(spark, paths, silver, sink=lines)
        gold_queries = []
        if not drop_bad:
            gold_queries.append(("silver_quarantine", silver_quarantine_stream(spark, paths, rules, max_files=max_files), None))
        kw = dict(max_files=max_files, state_partitions=state_partitions, rocksdb=rocksdb, output_files=output_files)
        if "final" in gold_modes:
            gold_queries.append(("gold", gold_final_stream(spark, paths, watermark, **kw), "gold"))
        if "live" in gold_modes:
            gold_queries.append(("gold_live", gold_live_stream(spark, paths, watermark, **kw), "gold_live"))
        await_layers(spark, paths, gold_queries, sink=lines)
    finally:
        write_batch_metrics(spark, lines, paths.metrics)


def start_layers(
    spark: SparkSession,
    raw: DataFrame,
    paths: LayerPaths,
    rules,
    *,
    trigger: dict | None = None,
    gold_modes: tuple[str, ...] = ("final",),
    watermark: str = DEFAULT_WATERMARK,
    max_files: int | None = None,
    max_file_age: str | None = None,
    state_partitions: int | None = None,
    rocksdb: bool = False,
    drop_bad: bool = False,
    output_files: int | None = None,
    duplicate_metrics: bool = False,
    fail_on_schema: bool = False,
    duplicate_horizon: str | None = None,
    distinct_sketches: bool = False,
) -> tuple[list[StreamingQuery], MetricsListener]:
    """Start all layers as long-running queries (default trigger: every
    5 minutes) and a listener that buffers their metric lines (schema check,
    duplicate counts and sketches as in :func:`run_layers`). Hand both to
    :func:`supervise_layers`: stateful queries run in sessions of their own, so
    ``spark.streams.awaitAnyTermination()`` would not notice that they fail."""
    from strata.streaming.recovery import recover_metrics

    recover_metrics(spark, paths, drop_bad)  # lines that a driver took with it
    trigger = trigger or {"processingTime": "5 minutes"}
    listener = MetricsListener(
        {
            "bronze": ("bronze", "bronze"), "silver": ("silver", "silver"), "gold_final": ("gold", "gold"), "gold_live": ("gold_live", "gold_live"),
            **({f"{x}_duplicates": (f"{x}_duplicates", f"{x}_duplicates") for x in ("bronze", "silver")} if duplicate_horizon else {}),
        }
    )
    spark.streams.addListener(listener)
    for folder in [paths.bronze, paths.silver, *([paths.bronze_all] if drop_bad else [])]:  # a file stream needs its folder
        fs, hpath = hadoop_path(spark, folder)
        fs.mkdirs(hpath)
    queries = bronze_stream(raw, paths, rules, trigger, drop_bad, fail_on_schema, distinct_sketches)
    queries += bronze_split_streams(spark, paths, rules, trigger, drop_bad, max_files)
    queries += silver_stream(spark, paths, rules, trigger, max_files, drop_bad=drop_bad, fail_on_schema=fail_on_schema, distinct_sketches=distinct_sketches)
    if not drop_bad:
        queries.append(silver_quarantine_stream(spark, paths, rules, trigger, max_files))
    for layer, folder in (("bronze", paths.bronze_all if drop_bad else paths.bronze), ("silver", paths.bronze)):
        found = _duplicate_queries(
            spark, paths, layer, folder, duplicate_metrics, duplicate_horizon, trigger, max_files, state_partitions, rocksdb, listener
        )
        queries += [q for _, q, _ in found]
    kw = dict(
        trigger=trigger,
        max_files=max_files,
        max_file_age=max_file_age,
        state_partitions=state_partitions,
        rocksdb=rocksdb,
        output_files=output_files,
        listener=listener,
    )
    if "final" in gold_modes:
        queries.append(gold_final_stream(spark, paths, watermark, **kw))
    if "live" in gold_modes:
        queries.append(gold_live_stream(spark, paths, watermark, **kw))
    listener.queries = list(queries)
    return queries, listener


def _named(layer: str, queries: list[StreamingQuery]):
    main, *quarantine = queries
    return [(layer, main, layer)] + [(f"{layer}_quarantine", q, None) for q in quarantine]


def supervise_layers(
    spark: SparkSession,
    queries: list[StreamingQuery],
    listener: MetricsListener,
    paths: LayerPaths,
    *,
    flush_every: float = 60.0,
    compact_every: float | None = 3600.0,
    repair_every: float | None = None,
    grace: float = 3600.0,
    run_for: float | None = None,
    poll: float = 1.0,
) -> None:
    """Supervise long-running layers (from :func:`start_layers`) on the driver:
    write the buffered metric lines every ``flush_every`` seconds, fold live
    Gold into its snapshot every ``compact_every`` seconds (when the live
    query runs), bring closed Gold hours in line with late rows every
    ``repair_every`` seconds (:mod:`strata.streaming.repair`), and return once a
    query stops or ``run_for`` seconds pass. What compaction and repair
    supersede stays ``grace`` seconds for readers.

    A failed query is not swallowed: the others are stopped, its error line
    is written and the exception is raised. On return the queries are
    stopped and the last lines flushed; restarting resumes from the
    checkpoints."""
    from strata.streaming.compaction import compact_live_gold

    from strata.streaming.repair import repair_gold

    start = last_flush = last_compact = last_repair = time.monotonic()
    live = any(q.name == "gold_live" for q in queries)
    failure = None
    try:
        while True:
            failed = next((q for q in queries if not q.isActive and q.exception() is not None), None)
            if failed is not None:
                failure = failed.exception()
                raise failure
            now = time.monotonic()
            if now - last_flush >= flush_every:
                listener.flush(spark, paths.metrics)
                last_flush = now
            if live and compact_every is not None and now - last_compact >= compact_every:
                compact_live_gold(spark, paths.gold_live, paths.gold_live_snapshot, grace=grace)
                last_compact = time.monotonic()
            if repair_every is not None and now - last_repair >= repair_every:
                repair_gold(spark, paths, grace=grace)
                last_repair = time.monotonic()
            if any(not q.isActive for q in queries) or (run_for is not None and now - start >= run_for):
                return
            time.sleep(poll)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        if failure is not None:
            # the listener records the failure asynchronously; wait briefly
            deadline = time.monotonic() + 10
            while time.monotonic() < deadline and not any(r[4] for r in listener.rows):
                time.sleep(0.1)
        listener.flush(spark, paths.metrics)
        spark.streams.removeListener(listener)
