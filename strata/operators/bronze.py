"""Raw layer: JSON text -> typed nested event rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from strata.schemas import BRONZE, METRIC_FIELDS, PARSED, RAW_TEXT

CORRUPT = "_corrupt_record"


def bronze_parse(raw: DataFrame, value_col: str = "value", keep_corrupt: bool = False) -> DataFrame:
    """Parse one JSON event per row into the Bronze schema.

    ``value`` may be text or bytes (a Kafka record). Parsing is permissive:
    bad JSON gives an all-NULL row, a wrongly typed field gives NULL for that
    field, unknown fields are ignored. With ``keep_corrupt`` the raw text of
    rows with any such fault is kept in ``_corrupt_record``.
    """
    text = F.col(value_col).cast("string")
    if not keep_corrupt:
        return raw.select(F.from_json(text, BRONZE).alias("data")).select("data.*")
    schema = StructType(list(BRONZE.fields) + [StructField(CORRUPT, StringType(), True)])
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT})
    return raw.select(parsed.alias("data")).select("data.*")


def bronze_table(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Records to rows of the Bronze table, parsed once: the event, and where
    nothing of a record could be read its text in ``raw`` and ``parsed`` false.

    A record of which some fields could be read is an event with NULL in the
    others. A record without text (NULL) has nothing to keep and is an event.
    """
    parsed = bronze_parse(raw, value_col, keep_corrupt=True)
    nothing = F.col(CORRUPT).isNotNull()
    for field in BRONZE.fieldNames():
        nothing &= F.col(field).isNull()
    return parsed.withColumn(RAW_TEXT, F.when(nothing, F.col(CORRUPT))).withColumn(PARSED, ~nothing).drop(CORRUPT)


def dead_letters(table: DataFrame) -> DataFrame:
    """``(raw)``: the text of the records of which nothing could be read."""
    return table.filter(~F.col(PARSED)).select(RAW_TEXT)


def with_flat_metrics(bronze: DataFrame) -> DataFrame:
    """Add one top-level column per metric, keeping the nested structs."""
    return bronze.withColumns({name: F.col(f"metrics.{name}") for name in METRIC_FIELDS})
