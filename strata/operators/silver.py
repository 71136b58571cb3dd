"""Typed layer: flatten the nested event and fill missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.schemas import ID_FIELDS, METRIC_FIELDS

# What a missing metric or note becomes in the Silver table.
SILVER_FILL = {"distance": 0.0, "temperature": 0.0, "amount": 0.0, "duration": 0, "note": ""}


def silver_flatten(bronze: DataFrame, fill: dict | None = SILVER_FILL) -> DataFrame:
    """Bronze rows -> Silver rows: metrics and note become columns, the
    structs are dropped, and NULL (and NaN) values are filled from ``fill``
    (pass ``fill=None`` to keep them)."""
    flat = bronze.select(
        *ID_FIELDS,
        *[F.col(f"metrics.{m}").alias(m) for m in METRIC_FIELDS],
        F.col("extra.note").alias("note"),
    )
    return flat.fillna(fill) if fill else flat
