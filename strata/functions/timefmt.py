"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import EVENT_DATE, EVENT_TS

# Fixed value: wire format of event timestamps (UTC, milliseconds, trailing Z).
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def event_time(column: str | Column) -> Column:
    """Parse ISO-8601 text to a timestamp; malformed text gives NULL
    instead of failing the query under ANSI mode."""
    return F.try_to_timestamp(_c(column))


def with_event_time(df: DataFrame, text: str = "timestamp") -> DataFrame:
    """``df`` with the typed event time and its date; where these columns are
    there already, they are taken as they are."""
    if EVENT_TS in df.columns and EVENT_DATE in df.columns:
        return df
    timed = df.withColumn(EVENT_TS, event_time(text))
    return timed.withColumn(EVENT_DATE, F.to_date(EVENT_TS))


def iso_millis(column: str | Column) -> Column:
    """Render a timestamp as ISO-8601 text with milliseconds and ``Z``."""
    return F.date_format(_c(column), ISO_MILLIS)
