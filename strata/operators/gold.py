"""Hourly facts: event-time tumbling windows over Silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.timefmt import with_event_time
from strata.schemas import EVENT_TS, GOLD_KEYS, METRIC_FIELDS

GROUP_FIELDS = ["event_type", "source", "status"]

# Output column order of the Gold table.
GOLD_ORDER = [
    "date_hour", "hour", "event_type", "source", "status", "event_count",
    "avg_distance", "avg_temperature", "avg_amount", "avg_duration",
    "min_distance", "max_distance", "min_temperature", "max_temperature",
    "min_amount", "max_amount", "min_duration", "max_duration",
]


def gold_windows(
    silver: DataFrame,
    window: str = "1 hour",
    watermark: str | None = None,
) -> DataFrame:
    """Aggregate Silver rows per (event-time window, event_type, source,
    status). Rows whose timestamp text does not parse are dropped. Rows that
    carry the typed event time already are not parsed again.

    With ``watermark`` (e.g. ``"25 hours"``) a stream keeps bounded state and
    may run in append mode; rows older than the watermark are dropped.
    Spark plans this as partial aggregation before the shuffle, so a hot key
    is pre-combined on every map task.
    """
    timed = with_event_time(silver).filter(F.col(EVENT_TS).isNotNull())
    if watermark:
        timed = timed.withWatermark(EVENT_TS, watermark)
    aggs = [F.count("event_id").alias("event_count")]
    aggs += [F.avg(m).alias(f"avg_{m}") for m in METRIC_FIELDS]
    aggs += [F.min(m).alias(f"min_{m}") for m in METRIC_FIELDS]
    aggs += [F.max(m).alias(f"max_{m}") for m in METRIC_FIELDS]
    return timed.groupBy(F.window(EVENT_TS, window).alias("window"), *GROUP_FIELDS).agg(*aggs)


def shape_gold(windows: DataFrame, created_at: bool = True) -> DataFrame:
    """Window aggregates -> the Gold layout (date and hour of the window
    start in the session time zone, which strata pins to UTC)."""
    cols = [
        F.to_date("window.start").alias("date_hour"),
        F.hour("window.start").alias("hour"),
        *[F.col(c) for c in GOLD_ORDER[2:]],
    ]
    if created_at:
        cols.append(F.current_timestamp().alias("created_at"))
    return windows.select(*cols)


def gold_hourly(
    silver: DataFrame,
    window: str = "1 hour",
    watermark: str | None = None,
    created_at: bool = True,
) -> DataFrame:
    """Silver rows -> Gold hourly facts (one row per grain key)."""
    return shape_gold(gold_windows(silver, window, watermark), created_at)


def gold_latest(live: DataFrame, version_col: str = "batch_id", keep_version: bool = False) -> DataFrame:
    """Latest row per Gold grain key from a live (update-mode) Gold table that
    holds one cumulative row per key and micro-batch. With ``keep_version``
    the result keeps ``version_col`` (the batch of each row's version).

    ``max_by`` is an ordinary aggregate, so Spark pre-aggregates per map task
    before the shuffle; a key with many versions never lands whole in one task.
    """
    payload = [c for c in live.columns if c not in GOLD_KEYS and c != version_col]
    if keep_version:
        payload.append(version_col)
    latest = live.groupBy(*GOLD_KEYS).agg(F.max_by(F.struct(*payload), F.col(version_col)).alias("_row"))
    return latest.select(*GOLD_KEYS, "_row.*")
