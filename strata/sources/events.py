"""Event-shaped rows derived from the driver ``events`` table, and the JSON
encoding that a producer would put on a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.timefmt import iso_millis
from strata.schemas import BRONZE_FIELDS


def event_rows(events: DataFrame) -> DataFrame:
    """Map driver events ``(event_id, ts, user_id, event_type, value, props)``
    to Bronze-shaped rows (nested ``metrics`` and ``extra``).

    ``k`` is the integer in ``props``. The mapping (fixed values):
    event_id = 'e' || event_id; timestamp = ts as ISO text with ms and Z;
    source = 'device_' || user_id; status = 'error' for error events, else
    'pending' when event_id % 3 = 0, else 'completed'; distance = k * 110.0;
    temperature = value - 50; amount = value, NULL when event_id % 10 = 0;
    duration = k * 1000; note = 'Normal', NULL when event_id % 7 = 0.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    eid = F.col("event_id")
    status = (
        F.when(F.col("event_type") == "error", F.lit("error"))
        .when(eid % 3 == 0, F.lit("pending"))
        .otherwise(F.lit("completed"))
    )
    metrics = F.struct(
        (k * F.lit(110.0)).alias("distance"),
        (F.col("value") - F.lit(50)).cast("double").alias("temperature"),
        F.when(eid % 10 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("amount"),
        (k * F.lit(1000)).cast("int").alias("duration"),
    )
    extra = F.struct(F.when(eid % 7 == 0, F.lit(None).cast("string")).otherwise(F.lit("Normal")).alias("note"))
    return events.select(
        F.concat(F.lit("e"), eid.cast("string")).alias("event_id"),
        iso_millis("ts").alias("timestamp"),
        F.col("event_type"),
        F.concat(F.lit("device_"), F.col("user_id").cast("string")).alias("source"),
        status.alias("status"),
        metrics.alias("metrics"),
        extra.alias("extra"),
    )


def event_json(columns: list[str] | None = None) -> Column:
    """JSON text of one event (NULL fields are left out, as on the wire)."""
    return F.to_json(F.struct(*(columns or BRONZE_FIELDS)))


def events_to_json(rows: DataFrame, *carry: str) -> DataFrame:
    """Bronze-shaped rows -> ``(key, value)`` records: the event id and the
    JSON text of the event, the layout a Kafka sink expects. ``carry``
    names extra columns to keep alongside."""
    return rows.select(F.col("event_id").alias("key"), event_json().alias("value"), *carry)


def faulty_records(rows: DataFrame, *carry: str) -> DataFrame:
    """Bronze-shaped rows -> ``value`` records with the faults that a real
    topic has, each from the number n in the event id (fixed values;
    ``carry`` as in :func:`events_to_json`):
    n % 13 = 0: delivered twice; n % 17 = 1: JSON text cut after 20
    characters; n % 19 = 2: the time is no time; n % 23 = 3: no time;
    n % 29 = 4: amount is text; n % 31 = 5: amount is -5.0.
    """
    n = F.substring("event_id", 2, 20).cast("long")
    time = F.when(n % 19 == 2, F.lit("not a time")).when(n % 23 == 3, F.lit(None).cast("string")).otherwise(F.col("timestamp"))
    amount = F.when(n % 29 == 4, F.lit(None).cast("double")).when(n % 31 == 5, F.lit(-5.0)).otherwise(F.col("metrics.amount"))
    changed = rows.withColumn("timestamp", time).withColumn("metrics", F.col("metrics").withField("amount", amount))
    text = event_json()
    text = F.when(n % 29 == 4, F.replace(text, F.lit('"duration"'), F.lit('"amount":"n/a","duration"'))).otherwise(text)
    text = F.when(n % 17 == 1, F.substring(text, 1, 20)).otherwise(text)
    return changed.select(F.explode(F.array_repeat(text, F.when(n % 13 == 0, 2).otherwise(1))).alias("value"), *carry)
