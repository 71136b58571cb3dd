"""The registered queries. Each takes ``(spark, sf_dir)`` and returns a
DataFrame computed from the driver tables in ``sf_dir`` (the ``events``
table, through the event-row mapping in :mod:`strata.sources.events`).

Batch queries are single plans over the whole table. Streaming queries run
the layer jobs over the whole table (landed as raw JSON files in the shared
checkpoint folder) and read back what the sinks committed.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.rules import load_rules
from strata.functions.timefmt import event_time
from strata.operators.bronze import bronze_parse, bronze_table, dead_letters, with_flat_metrics
from strata.operators.gold import GOLD_ORDER, gold_hourly
from strata.operators.health import (
    distinct_by_layer,
    duplicates_by_layer,
    metrics_summary,
    metrics_timeline,
    quarantine_files,
    quarantine_total,
    recent_errors,
)
from strata.operators.kpi import (
    hourly_volume,
    kpis_by_event_type,
    kpis_by_event_type_full,
    kpis_by_event_type_weighted,
    total_events,
)
from strata.operators.quality import distinct_over, distinct_sketches, duplicate_count, kind_errors, quality_report, quarantine_rows, sketch_error
from strata.operators.silver import silver_flatten
from strata.plans.backfill import backfill_layers
from strata.schemas import BRONZE, EVENTS, ID_FIELDS, METRIC_FIELDS, SILVER
from strata.session import default_parallelism, scratch_path, session_key, use_utc
from strata.sources.events import event_rows, events_to_json, faulty_records
from strata.sources.metrics import metrics_lines_from_events, read_metrics, write_metrics_log
from strata.plans.arrivals import land_deliveries, land_in_time_order
from strata.sources.raw import read_raw_stream
from strata.sources.tables import (
    read_bronze,
    read_dead_letters,
    read_gold,
    read_gold_current,
    read_gold_live,
    read_layer,
    read_quarantine,
    read_silver,
    read_table,
)
from strata.streaming.compaction import compact_live_gold
from strata.streaming.layers import LayerPaths, run_layers
from strata.streaming.repair import repair_gold

Query = Callable[[SparkSession, str], DataFrame]

# Averages are compared after rounding to this many places: their last bits
# depend on the summation order, which differs between engines.
AVG_PLACES = 6


# ---------------------------------------------------------------- inputs


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return read_table(spark, sf_dir, "events", EVENTS)


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(events(spark, sf_dir))


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_flatten(bronze_rows(spark, sf_dir))


def gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_hourly(silver_rows(spark, sf_dir), created_at=False)


def flat_bronze(bronze: DataFrame) -> DataFrame:
    """Bronze rows with the structs expanded (NULLs kept), for comparison."""
    return bronze.select(
        *ID_FIELDS, *[F.col(f"metrics.{m}").alias(m) for m in METRIC_FIELDS], F.col("extra.note").alias("note")
    )


def rounded_gold(gold: DataFrame) -> DataFrame:
    return gold.select(
        *[F.round(c, AVG_PLACES).alias(c) if c.startswith("avg_") else F.col(c) for c in GOLD_ORDER]
    )


# ---------------------------------------------------------------- batch queries


def q_events_to_json(spark, sf_dir):
    return events_to_json(bronze_rows(spark, sf_dir))


def q_bronze_parse(spark, sf_dir):
    return flat_bronze(bronze_parse(events_to_json(bronze_rows(spark, sf_dir))))


def q_silver_flatten(spark, sf_dir):
    return silver_rows(spark, sf_dir)


def q_gold_hourly(spark, sf_dir):
    return rounded_gold(gold_rows(spark, sf_dir))


def q_total_events(spark, sf_dir):
    return total_events(gold_table(spark, sf_dir))


def q_kpis_by_event_type(spark, sf_dir):
    return kpis_by_event_type(gold_table(spark, sf_dir))


def q_kpis_by_event_type_full(spark, sf_dir):
    return kpis_by_event_type_full(gold_table(spark, sf_dir))


def q_kpis_by_event_type_weighted(spark, sf_dir):
    return kpis_by_event_type_weighted(gold_table(spark, sf_dir))


def q_hourly_volume(spark, sf_dir):
    return hourly_volume(gold_table(spark, sf_dir))


# The dates of the date-bounded KPI query.
SOME_DATES = ("2024-01-05", "2024-01-11")


def q_kpis_by_event_type_dates(spark, sf_dir):
    return kpis_by_event_type(read_gold(spark, backfilled_layers(spark, sf_dir).gold, *SOME_DATES))


def q_quality_report(spark, sf_dir):
    return quality_report(with_flat_metrics(bronze_rows(spark, sf_dir)), load_rules())


def q_quarantine_rows(spark, sf_dir):
    return quarantine_rows(silver_rows(spark, sf_dir), load_rules())


def q_duplicate_count(spark, sf_dir):
    return duplicate_count(silver_rows(spark, sf_dir), "event_id")


# The same operators over records with faults (duplicates, broken JSON, bad and
# missing times, wrongly typed and out-of-range amounts).


def faulty_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_parse(faulty_records(bronze_rows(spark, sf_dir)))


def q_faulty_bronze_parse(spark, sf_dir):
    return flat_bronze(faulty_bronze(spark, sf_dir))


def q_faulty_gold_hourly(spark, sf_dir):
    return rounded_gold(gold_hourly(silver_flatten(faulty_bronze(spark, sf_dir)), created_at=False))


def q_faulty_quality_report(spark, sf_dir):
    return quality_report(with_flat_metrics(faulty_bronze(spark, sf_dir)), load_rules())


def q_faulty_quarantine_rows(spark, sf_dir):
    return quarantine_rows(silver_flatten(faulty_bronze(spark, sf_dir)), load_rules())


def q_faulty_duplicate_count(spark, sf_dir):
    return duplicate_count(silver_flatten(faulty_bronze(spark, sf_dir)), "event_id")


def q_faulty_dead_letters(spark, sf_dir):
    return dead_letters(bronze_table(faulty_records(bronze_rows(spark, sf_dir))))


def q_faulty_kind_errors(spark, sf_dir):
    return kind_errors(faulty_records(bronze_rows(spark, sf_dir)), BRONZE)


def q_distinct_ids_by_date(spark, sf_dir):
    """Distinct ids of each date, exact, and whether the merged sketches of its
    hours are within four standard errors of that."""
    events = silver_flatten(faulty_bronze(spark, sf_dir)).withColumn("at", event_time("timestamp"))
    by_hour = distinct_sketches(events, F.to_date("at").alias("date"), F.hour("at").alias("hour"))
    estimate = distinct_over(by_hour, "date").withColumnRenamed("distinct_ids", "estimate")
    exact = events.groupBy(F.to_date("at").alias("d")).agg(F.count_distinct("event_id").alias("distinct_ids"))
    near = F.abs(F.col("estimate") - F.col("distinct_ids")) <= 4 * sketch_error() * F.col("distinct_ids") + 1
    return estimate.join(exact, F.col("date").eqNullSafe(F.col("d"))).select("date", "rows", "distinct_ids", near.alias("near"))


# ---------------------------------------------------------------- metrics log

_metrics_logs: dict[tuple, str] = {}
_metrics_lock = threading.Lock()


def metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics log derived from ``events``, written once per session and
    table folder as NDJSON in the shared folder, read back leniently."""
    key = (session_key(spark), sf_dir)
    with _metrics_lock:
        path = _metrics_logs.get(key)
        if path is None:
            path = scratch_path(spark, "metrics-log")
            write_metrics_log(metrics_lines_from_events(events(spark, sf_dir)), path)
            _metrics_logs[key] = path
    return read_metrics(spark, path)


def q_metrics_summary(spark, sf_dir):
    return metrics_summary(metrics_log(spark, sf_dir))


def q_metrics_timeline(spark, sf_dir):
    return metrics_timeline(metrics_log(spark, sf_dir))


def q_recent_errors(spark, sf_dir):
    return recent_errors(metrics_log(spark, sf_dir), 10)


# ---------------------------------------------------------------- streaming queries

_stream_roots: dict[tuple, LayerPaths] = {}
_stream_lock = threading.Lock()

# Event-time slices in which the raw data arrives; the layer jobs resume
# from their checkpoints after each slice. Each slice lands as SLICE_FILES
# files and every query takes at most MAX_FILES of them in a micro-batch. Live
# Gold is compacted after the first slice, so reads go through a snapshot plus
# the batches that followed it.
ARRIVALS = 4
SLICE_FILES = 4
MAX_FILES = 2


def streamed_layers(spark: SparkSession, sf_dir: str) -> LayerPaths:
    """Land ``events`` as raw JSON files in event-time slices and, after each
    slice, resume Bronze -> Silver -> Gold (final and live) with
    ``availableNow``; once per session and folder."""
    with _stream_lock:
        key = (session_key(spark), sf_dir)
        paths = _stream_roots.get(key)
        if paths is None:
            paths = LayerPaths(scratch_path(spark, "layers"))
            raw_path = f"{paths.root}/raw"
            rules = load_rules()
            for i in land_in_time_order(bronze_rows(spark, sf_dir), raw_path, ARRIVALS, SLICE_FILES):
                run_layers(
                    spark,
                    read_raw_stream(spark, path=raw_path, max_per_trigger=MAX_FILES),
                    paths,
                    rules,
                    gold_modes=("final", "live"),
                    max_files=MAX_FILES * default_parallelism(spark),
                    state_partitions=default_parallelism(spark),
                )
                if i == 0:
                    compact_live_gold(spark, paths.gold_live, paths.gold_live_snapshot)
            _stream_roots[key] = paths
    return paths


def q_bronze_stream(spark, sf_dir):
    return flat_bronze(read_bronze(spark, streamed_layers(spark, sf_dir).bronze))


def q_silver_stream(spark, sf_dir):
    return read_layer(spark, streamed_layers(spark, sf_dir).silver, SILVER)


def streamed_quarantine(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The Bronze and Silver quarantine tables the stream chain wrote (each
    read through its file-sink log)."""
    paths = streamed_layers(spark, sf_dir)
    return read_quarantine(spark, os.path.join(paths.root, "quarantine"))


def q_quarantine_total(spark, sf_dir):
    return quarantine_total(streamed_quarantine(spark, sf_dir))


def q_quarantine_files(spark, sf_dir):
    return quarantine_files(streamed_quarantine(spark, sf_dir))


def q_gold_hourly_live(spark, sf_dir):
    paths = streamed_layers(spark, sf_dir)
    return rounded_gold(read_gold_live(spark, paths.gold_live, paths.gold_live_snapshot))


_backfill_roots: dict[tuple, LayerPaths] = {}
_backfill_lock = threading.Lock()


def backfilled_layers(spark: SparkSession, sf_dir: str) -> LayerPaths:
    """All layers built by the batch back-fill from the whole ``events``
    table (as JSON records), once per session and folder."""
    key = (session_key(spark), sf_dir)
    with _backfill_lock:
        paths = _backfill_roots.get(key)
        if paths is None:
            paths = LayerPaths(scratch_path(spark, "backfill"))
            backfill_layers(spark, events_to_json(bronze_rows(spark, sf_dir)), paths, load_rules())
            _backfill_roots[key] = paths
    return paths


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written Gold table, partitioned by date: what KPI queries read."""
    return read_gold(spark, backfilled_layers(spark, sf_dir).gold)


def q_gold_backfill(spark, sf_dir):
    return rounded_gold(gold_table(spark, sf_dir))


_rerun_roots: dict[tuple, LayerPaths] = {}


def q_backfill_rerun_range(spark, sf_dir):
    """Gold after a whole back-fill and a re-run of some of its dates."""
    key = (session_key(spark), sf_dir)
    with _backfill_lock:
        paths = _rerun_roots.get(key)
        if paths is None:
            paths = LayerPaths(scratch_path(spark, "rerun"))
            raw = events_to_json(bronze_rows(spark, sf_dir))
            backfill_layers(spark, raw, paths, load_rules())
            backfill_layers(spark, raw, paths, load_rules(), start_date=SOME_DATES[0], end_date=SOME_DATES[1])
            _rerun_roots[key] = paths
    return rounded_gold(read_gold(spark, paths.gold))


def q_backfill_after_stream(spark, sf_dir):
    """Gold of a back-fill from the Bronze rows that a stream wrote, into
    folders of its own (a back-fill refuses the stream's)."""
    key = (session_key(spark), sf_dir, "after-stream")
    streamed = streamed_layers(spark, sf_dir)
    with _backfill_lock:
        paths = _rerun_roots.get(key)
        if paths is None:
            paths = LayerPaths(scratch_path(spark, "after-stream"))
            backfill_layers(spark, events_to_json(read_bronze(spark, streamed.bronze)), paths, load_rules())
            _rerun_roots[key] = paths
    return rounded_gold(read_gold(spark, paths.gold))


# Records with faults in two deliveries: the second brings one row in LATE and
# every second copy of a record, most of them when the watermark has passed
# their hours. Then the closed hours are repaired from Silver.
LATE = 41
_faulty_roots: dict[tuple, LayerPaths] = {}


def faulty_layers(spark: SparkSession, sf_dir: str) -> LayerPaths:
    """The stream chain over the faulty records of the whole ``events`` table,
    with late deliveries and a repair; once per session and folder."""
    key = (session_key(spark), sf_dir)
    with _stream_lock:
        paths = _faulty_roots.get(key)
        if paths is None:
            paths = LayerPaths(scratch_path(spark, "faulty-layers"))
            rows, n = bronze_rows(spark, sf_dir), F.substring("event_id", 2, 20).cast("long")
            late = ~F.coalesce(n % LATE != 7, F.lit(False))
            for _ in land_deliveries(faulty_records(rows.withColumn("late", late), "late"), f"{paths.root}/raw"):
                run_layers(
                    spark,
                    read_raw_stream(spark, path=f"{paths.root}/raw"),
                    paths,
                    load_rules(),
                    state_partitions=default_parallelism(spark),
                    duplicate_horizon="24 hours",
                    distinct_sketches=True,
                )
            repair_gold(spark, paths)
            _faulty_roots[key] = paths
    return paths


def q_faulty_dead_letters_stream(spark, sf_dir):
    return read_dead_letters(spark, faulty_layers(spark, sf_dir).bronze)


def q_gold_hourly_repaired(spark, sf_dir):
    return rounded_gold(read_gold_current(spark, faulty_layers(spark, sf_dir)))


def q_silver_date_range(spark, sf_dir):
    """Silver of seven dates: a read of these partitions."""
    return read_silver(spark, faulty_layers(spark, sf_dir).silver, *SOME_DATES).select(*SILVER.fieldNames(), "event_date")


def q_faulty_duplicates_stream(spark, sf_dir):
    """Rows and duplicates of each layer over all batches, from the metric lines."""
    return duplicates_by_layer(read_metrics(spark, faulty_layers(spark, sf_dir).metrics))


def q_faulty_layer_metrics(spark, sf_dir):
    """Rows and dead letters of Bronze from its metric lines, and whether the
    merged sketches of its batches are near the distinct ids of the table."""
    paths = faulty_layers(spark, sf_dir)
    lines = read_metrics(spark, paths.metrics).filter("layer = 'bronze'")
    counts = lines.agg(F.sum("row_count").alias("rows"), F.sum(F.col("extra")["dead_letters"].cast("long")).alias("dead_letters"))
    (estimate,) = distinct_by_layer(lines).select("distinct_ids").first() or (0,)
    exact = read_bronze(spark, paths.bronze).agg(F.count_distinct("event_id")).first()[0]
    return counts.withColumn("distinct_near", F.lit(abs(estimate - exact) <= 4 * sketch_error() * exact + 1))


def q_gold_hourly_final(spark, sf_dir):
    return rounded_gold(read_gold_current(spark, streamed_layers(spark, sf_dir)))


def q_layer_metrics(spark, sf_dir):
    """Rows per layer from the metric lines that the streams wrote."""
    lines = read_metrics(spark, streamed_layers(spark, sf_dir).metrics)
    return lines.filter(F.col("layer").isin("bronze", "silver")).groupBy("layer").agg(F.sum("row_count").alias("rows"), F.count_if(F.col("error").isNotNull()).alias("errors"))


QUERIES: dict[str, Query] = {
    "events_to_json": q_events_to_json,
    "bronze_parse": q_bronze_parse,
    "silver_flatten": q_silver_flatten,
    "gold_hourly": q_gold_hourly,
    "total_events": q_total_events,
    "kpis_by_event_type": q_kpis_by_event_type,
    "kpis_by_event_type_full": q_kpis_by_event_type_full,
    "kpis_by_event_type_weighted": q_kpis_by_event_type_weighted,
    "kpis_by_event_type_dates": q_kpis_by_event_type_dates,
    "hourly_volume": q_hourly_volume,
    "quality_report": q_quality_report,
    "quarantine_rows": q_quarantine_rows,
    "duplicate_count": q_duplicate_count,
    "faulty_bronze_parse": q_faulty_bronze_parse,
    "faulty_gold_hourly": q_faulty_gold_hourly,
    "faulty_quality_report": q_faulty_quality_report,
    "faulty_quarantine_rows": q_faulty_quarantine_rows,
    "faulty_duplicate_count": q_faulty_duplicate_count,
    "faulty_dead_letters": q_faulty_dead_letters,
    "faulty_kind_errors": q_faulty_kind_errors,
    "distinct_ids_by_date": q_distinct_ids_by_date,
    "metrics_summary": q_metrics_summary,
    "metrics_timeline": q_metrics_timeline,
    "recent_errors": q_recent_errors,
    "quarantine_total": q_quarantine_total,
    "quarantine_files": q_quarantine_files,
    "bronze_stream": q_bronze_stream,
    "silver_stream": q_silver_stream,
    "gold_hourly_live": q_gold_hourly_live,
    "gold_hourly_final": q_gold_hourly_final,
    "layer_metrics": q_layer_metrics,
    "faulty_dead_letters_stream": q_faulty_dead_letters_stream,
    "gold_hourly_repaired": q_gold_hourly_repaired,
    "silver_date_range": q_silver_date_range,
    "faulty_duplicates_stream": q_faulty_duplicates_stream,
    "faulty_layer_metrics": q_faulty_layer_metrics,
    "gold_backfill": q_gold_backfill,
    "backfill_rerun_range": q_backfill_rerun_range,
    "backfill_after_stream": q_backfill_after_stream,
}


def run_query(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return QUERIES[name](spark, sf_dir)
