"""KPI queries over the Gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KPI_METRICS = ["distance", "temperature", "amount"]
KPI_METRICS_FULL = KPI_METRICS + ["duration"]


def total_events(gold: DataFrame) -> DataFrame:
    """One row: the sum of ``event_count`` (0 for an empty table)."""
    return gold.agg(F.coalesce(F.sum("event_count"), F.lit(0)).cast("long").alias("total_events"))


def _kpis(gold: DataFrame, metrics: list[str]) -> DataFrame:
    return (
        gold.groupBy("event_type")
        .agg(
            F.sum("event_count").alias("total_events"),
            *[F.round(F.avg(f"avg_{m}"), 2).alias(f"avg_{m}") for m in metrics],
        )
        .orderBy(F.desc("total_events"), F.asc("event_type"))
    )


def kpis_by_event_type(gold: DataFrame) -> DataFrame:
    """Per event type: total events and the (unweighted) mean of the hourly
    averages of distance, temperature and amount, rounded to 2 places."""
    return _kpis(gold, KPI_METRICS)


def kpis_by_event_type_full(gold: DataFrame) -> DataFrame:
    """:func:`kpis_by_event_type` plus the duration average."""
    return _kpis(gold, KPI_METRICS_FULL)


def kpis_by_event_type_weighted(gold: DataFrame) -> DataFrame:
    """Per event type, averages weighted by ``event_count``, i.e. the true
    per-event means: ``sum(avg * n) / sum(n)``, rounded to 2 places."""
    n = F.col("event_count")
    return (
        gold.groupBy("event_type")
        .agg(
            F.sum(n).alias("total_events"),
            *[F.round(F.sum(F.col(f"avg_{m}") * n) / F.sum(n), 2).alias(f"avg_{m}") for m in KPI_METRICS_FULL],
        )
        .orderBy(F.desc("total_events"), F.asc("event_type"))
    )


def hourly_volume(gold: DataFrame) -> DataFrame:
    """Events per hour of day, summed across all dates."""
    return gold.groupBy("hour").agg(F.sum("event_count").alias("events")).orderBy("hour")
