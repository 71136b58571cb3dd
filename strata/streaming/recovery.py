"""Metric lines that a dead driver did not write.

Lines of committed batches wait in the driver's memory until they are flushed.
What they count is still there after a crash: the checkpoint says which batches
were committed, and the sink log which files each of them added. At a start,
every committed batch of a layer without a line gets one whose rows are counted
from its files; ``extra`` says so (``rebuilt``) instead of holding rule counts.

A line belongs to a batch of the present checkpoint if it is not older than it,
so lines from before a reset are never taken for those of a new batch 0, and a
batch that has its line gets no second one. Spark keeps the commits of about the
last hundred batches; older ones were flushed long ago.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.sources.epochs import gold_epochs
from strata.sources.metrics import read_metrics
from strata.storage import hadoop_path
from strata.streaming.layers import LayerPaths, gold_checkpoint
from strata.streaming.metrics_sink import write_batch_metrics


def _names(spark: SparkSession, folder: str) -> dict[str, object]:
    fs, root = hadoop_path(spark, folder)
    return {s.getPath().getName(): s for s in fs.listStatus(root)} if fs.exists(root) else {}


def committed_batches(spark: SparkSession, checkpoint: str) -> set[int]:
    return {int(n) for n in _names(spark, f"{checkpoint}/commits") if n.isdigit()}


def _lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of a small file; none if there is no such file."""
    fs, hpath = hadoop_path(spark, path)
    if not fs.exists(hpath):
        return []
    stream = fs.open(hpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()


def _entries(spark: SparkSession, path: str) -> list[str]:
    """Files that a sink log file adds: one batch's, or all since the log began."""
    return [e["path"] for e in map(json.loads, _lines(spark, path)[1:]) if e.get("action", "add") == "add"]


def had_input(spark: SparkSession, checkpoint: str, batch: int) -> bool:
    """Whether a batch read anything: its source offsets are not those of the batch before."""
    own, before = (_lines(spark, f"{checkpoint}/offsets/{b}")[2:] for b in (batch, batch - 1))
    return bool(own) and own != before


def files_of_batch(spark: SparkSession, sink: str, batch: int) -> list[str] | None:
    """Files that a batch added to a file sink; None if the log does not tell.
    Every tenth log file lists all files so far; a batch's own are those that
    the files before it do not list."""
    log = f"{sink}/_spark_metadata"
    names = _names(spark, log)
    if str(batch) in names:
        return _entries(spark, f"{log}/{batch}")
    if f"{batch}.compact" not in names:
        return None
    earlier = sorted(int(n) for n in names if n.isdigit() and int(n) < batch)
    compacts = sorted(int(n.split(".")[0]) for n in names if n.endswith(".compact") and int(n.split(".")[0]) < batch)
    last = compacts[-1] if compacts else -1
    if any(b not in earlier for b in range(last + 1, batch)):
        return None
    before = set(_entries(spark, f"{log}/{last}.compact")) if compacts else set()
    for b in range(last + 1, batch):
        before.update(_entries(spark, f"{log}/{b}"))
    return [f for f in _entries(spark, f"{log}/{batch}.compact") if f not in before]


def missing_lines(spark: SparkSession, paths: LayerPaths, layer: str, checkpoint: str, sink: str) -> list[tuple]:
    """A metric line for each committed batch of a layer that has none."""
    meta = _names(spark, checkpoint).get("metadata")
    commits = committed_batches(spark, checkpoint)
    if meta is None or not commits:
        return []
    since = meta.getModificationTime() // 1000
    lines = read_metrics(spark, paths.metrics).filter((F.col("layer") == layer) & (F.col("ts") >= since) & F.coalesce(F.col("error") == "", F.col("error").isNull()))
    have = {r[0] for r in lines.filter(F.col("batch_id") >= min(commits)).select("batch_id").distinct().collect()}
    out = []
    for batch in sorted(commits - have):
        files = files_of_batch(spark, sink, batch)
        if files or had_input(spark, checkpoint, batch):  # else the batch has no line
            rows = spark.read.parquet(*files).count() if files else 0
            note = {"rebuilt": "true"} if rows else {"rebuilt": "true", "note": "empty_batch"}
            out.append((int(time.time()), layer, batch, rows, None, note))
    return out


def recover_metrics(spark: SparkSession, paths: LayerPaths, drop_bad: bool = False) -> int:
    """Write the lines that are missing; returns how many. Run it before the
    layers start, while no query writes (:func:`strata.streaming.layers.start_layers` does)."""
    bronze = ("bronze", "bronze_all", paths.bronze_all) if drop_bad else ("bronze", "bronze", paths.bronze)
    lines: list[tuple] = []
    for layer, name, sink in (bronze, ("silver", "silver", paths.silver)):
        lines += missing_lines(spark, paths, layer, paths.checkpoint(name), sink)
    epoch = gold_epochs(spark, paths.gold)[-1]
    lines += missing_lines(spark, paths, "gold", gold_checkpoint(paths, epoch.number), epoch.folder)
    write_batch_metrics(spark, lines, paths.metrics)
    return len(lines)
