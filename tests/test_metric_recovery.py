"""Metric lines of a driver that died between two flushes."""

import shutil
import threading
from types import SimpleNamespace

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.events import event_rows
from strata.sources.metrics import read_metrics
from strata.sources.raw import read_raw_stream, write_raw_files
from strata.streaming.layers import LayerPaths, reset_layer, run_layers, start_layers
from strata.streaming.metrics_sink import MetricsListener
from strata.streaming.recovery import committed_batches, files_of_batch, recover_metrics

from .conftest import SF_SMALL


def _rows(spark):
    return event_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet"))


def _lines(spark, paths):
    return sorted((r.layer, r.batch_id, r.row_count) for r in read_metrics(spark, paths.metrics).collect())


def test_a_dead_driver_loses_and_doubles_no_line(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-dead-driver"))
    raw = f"{paths.root}/raw"
    write_raw_files(_rows(spark), raw, 3)
    queries, listener = start_layers(
        spark, read_raw_stream(spark, path=raw, max_per_trigger=1), paths, rules, trigger={"processingTime": "200 milliseconds"}, state_partitions=2
    )
    try:
        for q in queries:
            q.processAllAvailable()
        for q in queries:
            q.stop()
        want = sorted((r[1], r[2], r[3]) for r in listener.rows)
    finally:
        spark.streams.removeListener(listener)
    assert len([x for x in want if x[0] == "bronze"]) == 3 and _lines(spark, paths) == []  # nothing was flushed
    queries, listener = start_layers(spark, read_raw_stream(spark, path=raw), paths, rules, state_partitions=2)
    for q in queries:
        q.stop()
    spark.streams.removeListener(listener)
    assert _lines(spark, paths) == want
    assert recover_metrics(spark, paths) == 0
    assert _lines(spark, paths) == want


def test_lines_of_reported_batches_are_awaited():
    p = SimpleNamespace(id="q", name="bronze", batchId=0, numInputRows=7, observedMetrics={}, stateOperators=[], timestamp="2024-01-01T00:00:00Z")
    listener = MetricsListener({"bronze": ("bronze", None)})
    listener.queries = [SimpleNamespace(recentProgress=[p])]
    late = threading.Timer(0.5, listener.onQueryProgress, [SimpleNamespace(progress=p)])
    late.start()
    assert [r[1:4] for r in listener.rows] == [("bronze", 0, 7)]
    late.join()


def test_only_lines_of_this_checkpoint_count(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-lines-reset"))
    raw = f"{paths.root}/raw"
    write_raw_files(_rows(spark).limit(50), raw, 1)
    run = lambda: run_layers(spark, read_raw_stream(spark, path=raw), paths, rules, gold_modes=())
    run()
    first = _lines(spark, paths)
    reset_layer(spark, paths, "bronze")
    kept = f"{paths.root}/kept"
    run()
    # The lines of the second run are lost, those before the reset are not theirs.
    lines = read_metrics(spark, paths.metrics).withColumn("ts", F.col("ts") - 100).filter("false")
    assert lines.count() == 0
    shutil.move(paths.metrics.removeprefix("file:"), kept.removeprefix("file:"))
    old = read_metrics(spark, kept).limit(len(first)).withColumn("ts", F.lit(1_600_000_000).cast("long"))
    old.write.option("ignoreNullFields", "false").json(paths.metrics)
    assert recover_metrics(spark, paths) == 2
    found = read_metrics(spark, paths.metrics).filter("ts > 1600000000").collect()
    assert sorted((r.layer, r.batch_id, r.row_count) for r in found) == [("bronze", 0, 50), ("silver", 0, 50)]


def test_files_of_every_batch_also_of_compacted_logs(spark, tmp_path):
    src, sink, ck = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ck")
    for i in range(13):
        spark.range(i * 10, i * 10 + i + 1, 1, 1).write.mode("append").parquet(src)
        q = spark.readStream.schema("id long").parquet(src).writeStream.option("checkpointLocation", ck).trigger(availableNow=True).start(sink)
        q.awaitTermination()
    commits = committed_batches(spark, ck)
    assert commits == set(range(13))
    sizes = {}
    for b in commits:
        files = files_of_batch(spark, sink, b)
        if files is not None:
            sizes[b] = spark.read.parquet(*files).count()
    assert sizes[12] == 13 and all(n == b + 1 for b, n in sizes.items()) and 9 in sizes
