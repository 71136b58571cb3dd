"""Table schemas: one definition per layer, shared by batch and stream code."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The event field names, metric names and the note field.
ID_FIELDS = ["event_id", "timestamp", "event_type", "source", "status"]
METRIC_FIELDS = ["distance", "temperature", "amount", "duration"]
NOTE_FIELD = "note"

METRICS_STRUCT = StructType(
    [
        StructField("distance", DoubleType(), True),
        StructField("temperature", DoubleType(), True),
        StructField("amount", DoubleType(), True),
        StructField("duration", IntegerType(), True),
    ]
)

EXTRA_STRUCT = StructType([StructField("note", StringType(), True)])

# Raw layer: the event as sent on the wire, nested.
BRONZE = StructType(
    [StructField(n, StringType(), True) for n in ID_FIELDS]
    + [
        StructField("metrics", METRICS_STRUCT, True),
        StructField("extra", EXTRA_STRUCT, True),
    ]
)

# The Bronze table: the text of a record that did not parse stands beside the
# (empty) event, in partitions of its own.
RAW_TEXT, PARSED = "raw", "parsed"
BRONZE_TABLE = StructType([*BRONZE.fields, StructField(RAW_TEXT, StringType(), True), StructField(PARSED, BooleanType(), True)])

# Typed layer: flat, one column per metric.
SILVER = StructType(
    [StructField(n, StringType(), True) for n in ID_FIELDS]
    + list(METRICS_STRUCT.fields)
    + [StructField(NOTE_FIELD, StringType(), True)]
)

# The Silver table: the event time as a timestamp, and its date as partition.
EVENT_TS, EVENT_DATE = "event_ts", "event_date"
SILVER_TABLE = StructType([*SILVER.fields, StructField(EVENT_TS, TimestampType(), True), StructField(EVENT_DATE, DateType(), True)])

# Hourly facts. Grain: (date_hour, hour, event_type, source, status).
GOLD_KEYS = ["date_hour", "hour", "event_type", "source", "status"]
GOLD = StructType(
    [
        StructField("date_hour", DateType(), True),
        StructField("hour", IntegerType(), True),
        StructField("event_type", StringType(), True),
        StructField("source", StringType(), True),
        StructField("status", StringType(), True),
        StructField("event_count", LongType(), False),
        StructField("avg_distance", DoubleType(), True),
        StructField("avg_temperature", DoubleType(), True),
        StructField("avg_amount", DoubleType(), True),
        StructField("avg_duration", DoubleType(), True),
        StructField("min_distance", DoubleType(), True),
        StructField("max_distance", DoubleType(), True),
        StructField("min_temperature", DoubleType(), True),
        StructField("max_temperature", DoubleType(), True),
        StructField("min_amount", DoubleType(), True),
        StructField("max_amount", DoubleType(), True),
        StructField("min_duration", IntegerType(), True),
        StructField("max_duration", IntegerType(), True),
        StructField("created_at", TimestampType(), True),
    ]
)

# Live Gold rows carry the micro-batch that produced them.
GOLD_LIVE = StructType(list(GOLD.fields) + [StructField("batch_id", LongType(), True)])

# Lines of a text file.
TEXT = StructType([StructField("value", StringType(), True)])

# One line per micro-batch of a layer job.
METRICS = StructType(
    [
        StructField("ts", LongType(), True),
        StructField("layer", StringType(), True),
        StructField("batch_id", LongType(), True),
        StructField("row_count", LongType(), True),
        StructField("error", StringType(), True),
        StructField("extra", MapType(StringType(), StringType()), True),
    ]
)

# Driver ``events`` table (source of the event-shaped rows in tests and
# registered queries). Declared, so reads skip schema inference.
EVENTS = StructType(
    [
        StructField("event_id", LongType(), True),
        StructField("ts", TimestampNTZType(), True),
        StructField("user_id", LongType(), True),
        StructField("event_type", StringType(), True),
        StructField("value", DoubleType(), True),
        StructField("props", StringType(), True),
    ]
)

# Quarantine rows: the layer's row (Bronze with its metrics flat as well) and
# the rule it broke.
_RULE = [StructField("rule", StringType(), True)]
QUARANTINE = {
    "bronze": StructType(list(BRONZE.fields) + list(METRICS_STRUCT.fields) + _RULE),
    "silver": StructType(list(SILVER.fields) + _RULE),
}

# Raw stream records: the JSON text of one event per row.
RAW = StructType([StructField("value", StringType(), True)])

BRONZE_FIELDS = [f.name for f in BRONZE.fields]
SILVER_FIELDS = [f.name for f in SILVER.fields]
