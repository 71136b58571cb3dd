"""Final Gold goes on in a new epoch: another number of state partitions, a sink log of its own."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.gold import gold_hourly
from strata.operators.silver import silver_flatten
from strata.plans.arrivals import land_in_time_order
from strata.session import scratch_path
from strata.sources.epochs import Epoch, gold_epochs
from strata.sources.events import event_rows
from strata.sources.raw import read_raw_stream, write_raw_files
from strata.sources.tables import read_gold, read_gold_current
from strata.streaming.epochs import roll_gold
from strata.streaming.layers import LayerPaths, gold_checkpoint, gold_final_stream, reset_layer, run_layers
from strata.streaming.repair import repair_gold

from .conftest import SF_SMALL


def _rows(spark):
    return event_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet"))


def _run(spark, paths, rules, partitions):
    run_layers(spark, read_raw_stream(spark, path=f"{paths.root}/raw"), paths, rules, state_partitions=partitions)


def _rounded(gold):
    return gold.drop("created_at").select(*[F.round(c, 6).alias(c) if c.startswith("avg_") else F.col(c) for c in gold.drop("created_at").columns])


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _state_partitions(paths, epoch):
    folder = os.path.join(gold_checkpoint(paths, epoch).removeprefix("file:"), "state", "0")
    return len([d for d in os.listdir(folder) if d.isdigit()])


def test_state_restarts_under_another_partition_count(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-epochs"))
    rows = _rows(spark)
    assert roll_gold(spark, paths) is None  # no hour was closed
    partitions, rolled = [2, 5, 3, 3], []
    for i in land_in_time_order(rows, f"{paths.root}/raw", 4):
        _run(spark, paths, rules, partitions[i])
        if i < 2:
            rolled.append(roll_gold(spark, paths))
            assert roll_gold(spark, paths) in (None, *rolled) and len(gold_epochs(spark, paths.gold)) == len(rolled) + 1
    assert rolled == [1, 2]
    assert [_state_partitions(paths, e) for e in range(3)] == [2, 5, 3]
    want = _rounded(gold_hourly(silver_flatten(rows), created_at=False))
    assert _same(_rounded(read_gold_current(spark, paths)), want)
    closed = read_gold(spark, paths.gold)
    assert closed.count() == closed.select("date_hour", "hour", "event_type", "source", "status").distinct().count()
    # Each epoch logs its own files; a read of some dates opens the logs of their epochs only.
    epochs = gold_epochs(spark, paths.gold)
    assert all(os.path.isdir(f"{e.folder.removeprefix('file:')}/_spark_metadata") for e in epochs)
    first = read_gold(spark, paths.gold, "2024-01-02", "2024-01-03")
    assert {os.path.dirname(os.path.dirname(f)) for f in first.inputFiles()} == {os.path.realpath(paths.gold.removeprefix("file:")).join(["file://", ""])}
    assert _same(_rounded(first), want.filter("date_hour BETWEEN DATE '2024-01-02' AND DATE '2024-01-03'"))


def test_rows_before_an_epoch_are_repaired_and_a_reset_ends_epochs(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-epochs-late"))
    rows = _rows(spark)
    n = F.substring("event_id", 2, 20).cast("long")
    write_raw_files(rows.filter(n % 9 != 2), f"{paths.root}/raw", 1)
    _run(spark, paths, rules, 2)
    assert roll_gold(spark, paths) == 1
    write_raw_files(rows.filter(n % 9 == 2), f"{paths.root}/raw", 1)
    _run(spark, paths, rules, 4)
    assert repair_gold(spark, paths)
    want = _rounded(gold_hourly(silver_flatten(rows), created_at=False))
    assert _same(_rounded(read_gold_current(spark, paths)), want)
    reset_layer(spark, paths, "gold")
    assert len(gold_epochs(spark, paths.gold)) == 1 and not os.path.exists(gold_checkpoint(paths, 1).removeprefix("file:"))
    _run(spark, paths, rules, 3)
    assert _same(_rounded(read_gold_current(spark, paths)), want)


def test_epochs_that_a_range_needs():
    day = 86400
    epochs = [Epoch(0, "a", None, 10 * day), Epoch(1, "b", 10 * day, 12 * day + 3600), Epoch(2, "c", 12 * day + 3600)]
    names = lambda a, b: [e.folder for e in epochs if e.overlaps(a, b)]
    assert names(None, None) == ["a", "b", "c"]
    assert names(None, "1970-01-10") == ["a"] and names(None, "1970-01-11") == ["a", "b"]
    assert names("1970-01-11", "1970-01-12") == ["b"] and names("1970-01-13", None) == ["b", "c"] and names("1970-01-14", None) == ["c"]


def test_a_running_gold_query_is_refused(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-epochs-running"))
    write_raw_files(_rows(spark), f"{paths.root}/raw", 1)
    _run(spark, paths, rules, 2)
    q = gold_final_stream(spark, paths, trigger={"processingTime": "1 hour"}, state_partitions=2)  # in a session of its own
    try:
        with pytest.raises(RuntimeError, match="stop the Gold query"):
            roll_gold(spark, paths)
    finally:
        q.stop()
    assert roll_gold(spark, paths) == 1
