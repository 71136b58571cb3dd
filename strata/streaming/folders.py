"""Folders of the layer tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.storage import delete, hadoop_path, numbered_folders  # noqa: F401


def done_root(live_path: str) -> str:
    return live_path.rstrip("/") + "_done"


def mark_done(spark: SparkSession, live_path: str, batch_id: int) -> None:
    """Mark a live Gold batch as whole. On stores where a rename copies, a
    batch folder can be seen half-written; only the mark says it is done."""
    fs, hpath = hadoop_path(spark, f"{done_root(live_path)}/batch_id={batch_id}")
    fs.create(hpath, True).close()
