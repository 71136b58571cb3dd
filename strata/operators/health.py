"""Health reports over the metrics log and the quarantine tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import distinct_over

# The layers with a column of their own in the timeline; the rest is ``other``.
LAYERS = ("bronze", "silver", "gold")


def is_error(column: str = "error") -> Column:
    """A metric line records an error when ``error`` is a non-empty text."""
    return F.coalesce(F.col(column), F.lit("")) != F.lit("")


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """Per layer (missing layer -> ``unknown``): batches, rows (missing
    ``row_count`` counts as 0) and batches with an error."""
    return metrics.groupBy(F.coalesce(F.col("layer"), F.lit("unknown")).alias("layer")).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum(F.coalesce(F.col("row_count"), F.lit(0))).cast("long").alias("rows"),
        F.count_if(is_error()).alias("errors"),
    )


def metrics_timeline(metrics: DataFrame, layers: Sequence[str] = LAYERS) -> DataFrame:
    """Rows processed per metric timestamp, one column for each of ``layers``
    (0 where a layer wrote nothing) and ``other`` for all layers not named.
    Lines without a timestamp (NULL or 0) or without a layer are left out.

    The caller names the layers, so the pivot is written as one conditional
    aggregation per timestamp: one partial + final aggregate and one shuffle,
    where ``groupBy().pivot()`` would aggregate by (timestamp, layer) first
    and shuffle twice."""
    timed = metrics.filter(F.col("ts").isNotNull() & (F.col("ts") != 0) & F.col("layer").isNotNull())
    per_layer = [
        F.coalesce(F.sum(F.when(F.col("layer") == F.lit(layer), F.col("row_count"))), F.lit(0)).cast("long").alias(layer)
        for layer in layers
    ]
    named = F.col("layer").isin(*layers) if layers else F.lit(False)
    per_layer.append(F.coalesce(F.sum(F.when(~named, F.col("row_count"))), F.lit(0)).cast("long").alias("other"))
    pivoted = timed.groupBy(F.timestamp_seconds("ts").cast("timestamp_ntz").alias("timestamp")).agg(*per_layer)
    return pivoted.orderBy("timestamp")


def recent_errors(metrics: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most recent metric lines that record an error (top-k by
    time, then batch)."""
    return (
        metrics.filter(is_error())
        .select("ts", "layer", "batch_id", "error")
        .orderBy(F.desc_nulls_last("ts"), F.desc_nulls_last("batch_id"), F.asc_nulls_last("layer"))
        .limit(n)
    )


def _with_all(parts: list[DataFrame], column: str) -> DataFrame:
    """One-row counts per layer, and their sum as ``all``."""
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts.unionByName(counts.agg(F.lit("all").alias("layer"), F.sum(column).alias(column)))


def quarantine_total(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Quarantined rows per layer (0 where there are none) plus an ``all``
    row. A record quarantined at two layers counts once in each. Each layer is
    counted on its own, so Parquet footers can answer."""
    if not layers:
        raise ValueError("no layers given")
    parts = [df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows")) for name, df in layers.items()]
    return _with_all(parts, "rows")


def quarantine_files(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Number of non-empty quarantine files per layer plus an ``all`` row.
    Each input must be a file scan (it reads ``_metadata.file_path``) or empty."""
    if not layers:
        raise ValueError("no layers given")
    parts = []
    for name, df in layers.items():
        try:
            files = df.select(F.col("_metadata.file_path").alias("file"))
        except AnalysisException as exc:
            if not (exc.getCondition() or "").startswith("UNRESOLVED_COLUMN") or "_metadata" not in str(exc):
                raise
            # not a file scan: a layer with no folder yet
            files = df.select(F.lit(None).cast("string").alias("file"))
        parts.append(files.agg(F.lit(name).alias("layer"), F.count_distinct("file").alias("files")))
    return _with_all(parts, "files")


def distinct_by_layer(metrics: DataFrame, key: str = "event_ids") -> DataFrame:
    """``(layer, rows, distinct_ids)`` over the metric lines that carry a sketch
    of their batch's ids: the sketches are merged, no data is read. The count is
    approximate (:func:`strata.operators.quality.sketch_error`)."""
    lines = metrics.filter(F.col("extra")[key].isNotNull())
    return distinct_over(lines.select("layer", F.col("row_count").alias("rows"), F.unbase64(F.col("extra")[key]).alias("ids")), "layer")


def duplicates_by_layer(metrics: DataFrame) -> DataFrame:
    """``(layer, rows, duplicates)`` over the metric lines of the duplicate counts."""
    lines = metrics.filter(F.col("layer").endswith("_duplicates"))
    return lines.groupBy("layer").agg(F.sum("row_count").alias("rows"), F.sum(F.col("extra")["duplicates"].cast("long")).alias("duplicates"))
