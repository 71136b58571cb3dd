"""Raw event streams: a Kafka topic, or files holding one JSON text per row.

The Kafka connector is not bundled; when its package is on the classpath the
same code path reads a topic. Everything downstream only needs a ``value``
column, so tests and batch back-fills use files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import RAW


# Spark's own default skips files more than 7 days older than the newest one
# seen; history that was copied with its times kept would be lost silently.
ANY_AGE = "36500d"


def read_raw_stream(
    spark: SparkSession,
    *,
    path: str | None = None,
    fmt: str = "parquet",
    kafka_servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "latest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Streaming DataFrame with one ``value: string`` column.

    With ``kafka_servers`` and ``topic`` it subscribes to the topic (binary
    ``value`` cast to text); otherwise it reads ``path`` as a file stream with
    a fixed schema. ``max_per_trigger`` bounds each micro-batch (offsets for
    Kafka, files for a file source); ``min_partitions`` lets Spark split
    Kafka partitions so parsing is not capped at the topic's partition count.
    """
    if kafka_servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", kafka_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        if min_partitions:
            reader = reader.option("minPartitions", min_partitions)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if path is None:
        raise ValueError("read_raw_stream needs a path or kafka_servers + topic")
    reader = spark.readStream.format(fmt).schema(RAW).option("maxFileAge", ANY_AGE)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.load(path).select("value")


def write_raw_files(rows: DataFrame, path: str, num_files: int) -> None:
    """Land Bronze-shaped rows as JSON records in ``num_files`` Parquet files,
    range-split on the event timestamp (a batch back-fill of a raw folder).

    A per-row sequence number breaks ties, so a timestamp shared by a third
    of the rows (or by every copy of a duplicated event) is cut across files
    instead of landing in one task. For a file scan the sequence is the same
    on a retried task, so the split is repeatable."""
    from strata.sources.events import events_to_json

    ranged = rows.withColumn("_seq", F.monotonically_increasing_id()).repartitionByRange(num_files, "timestamp", "_seq")
    events_to_json(ranged.drop("_seq")).write.mode("append").parquet(path)
