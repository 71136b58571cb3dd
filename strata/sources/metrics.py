"""The per-batch metrics log (NDJSON): reader, and a log derived from the
driver ``events`` table for tests and registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import METRICS, TEXT
from strata.sources.tables import read_or_empty


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Read metric lines with a fixed schema. Lines that are not a JSON object
    are dropped; a wrongly typed field is NULL and its line stays, whichever
    columns a query reads. A missing log reads as empty."""
    lines = read_or_empty(spark, path, TEXT, fmt="text")
    objects = lines.filter(F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("{"))
    return objects.select(F.from_json("value", METRICS).alias("line")).select("line.*")


def metrics_lines_from_events(events: DataFrame) -> DataFrame:
    """One metric line per driver event, as JSON text in a ``value`` column.

    Mapping (fixed values), with k the integer in ``props``:
    ts = epoch seconds of ts truncated to the minute, 0 when event_id % 50 = 0;
    layer = bronze/silver/gold for event_id % 4 = 0/1/2, missing for 3;
    batch_id = event_id; row_count = k, missing when event_id % 11 = 0;
    error = 'batch failed: <event_type>' for error events with even id,
    '' when event_id % 5 = 0, else missing; extra = {"note": "empty_batch"}
    when k = 0. Every 97th event is followed by an extra, truncated
    (unparsable) line.
    """
    k = F.get_json_object("props", "$.k").cast("long")
    eid = F.col("event_id")
    minute = F.unix_seconds(F.date_trunc("minute", F.col("ts").cast("timestamp")))
    line = F.struct(
        F.when(eid % 50 == 0, F.lit(0).cast("long")).otherwise(minute).alias("ts"),
        F.when(eid % 4 == 0, F.lit("bronze"))
        .when(eid % 4 == 1, F.lit("silver"))
        .when(eid % 4 == 2, F.lit("gold"))
        .alias("layer"),
        eid.alias("batch_id"),
        F.when(eid % 11 == 0, F.lit(None).cast("long")).otherwise(k).alias("row_count"),
        F.when(
            (F.col("event_type") == "error") & (eid % 2 == 0),
            F.concat(F.lit("batch failed: "), F.col("event_type")),
        )
        .when(eid % 5 == 0, F.lit(""))
        .alias("error"),
        F.when(k == 0, F.create_map(F.lit("note"), F.lit("empty_batch"))).alias("extra"),
    )
    text = F.to_json(line)
    bad = F.substring(text, 1, 12)
    return events.select(F.explode(F.when(eid % 97 == 0, F.array(text, bad)).otherwise(F.array(text))).alias("value"))


def write_metrics_log(lines: DataFrame, path: str) -> None:
    """Write ``value`` lines as a text (NDJSON) dataset."""
    lines.select("value").write.mode("errorifexists").text(path)
