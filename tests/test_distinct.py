"""Distinct and duplicate counts that go across batches, dates and runs."""

import pytest
from pyspark.sql import functions as F

from strata.operators.health import distinct_by_layer, duplicates_by_layer
from strata.operators.quality import distinct_over, distinct_sketches, duplicate_count, sketch_error
from strata.session import scratch_path
from strata.sources.events import event_rows, events_to_json
from strata.sources.metrics import read_metrics
from strata.sources.raw import read_raw_stream
from strata.streaming.layers import LayerPaths, run_layers, start_layers

from .conftest import SF_SMALL


def _records(spark):
    return events_to_json(event_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet"))).select("value")


def test_a_duplicate_in_two_batches_is_counted(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-dup-batches"))
    raw, records = f"{paths.root}/raw", _records(spark)
    no_id = spark.createDataFrame([('{"event_type": "click"}',)] * 3, "value string")
    for part in (records, records.limit(40), records.limit(60).unionByName(no_id)):  # three runs resume one state
        part.write.mode("append").parquet(raw)
        run_layers(
            spark, read_raw_stream(spark, path=raw), paths, rules, gold_modes=(), state_partitions=2, duplicate_horizon="24 hours", distinct_sketches=True
        )
    lines = read_metrics(spark, paths.metrics)
    assert {tuple(r) for r in duplicates_by_layer(lines).collect()} == {("bronze_duplicates", 1103, 103), ("silver_duplicates", 1103, 103)}
    # Counted inside each batch alone, only the records without an id would show.
    found = {r.layer: (r.rows, r.distinct_ids) for r in distinct_by_layer(lines).collect()}
    assert set(found) == {"bronze", "silver"}
    for rows, distinct in found.values():
        assert rows == 1103 and abs(distinct - 1000) <= 4 * sketch_error() * 1000


def test_long_running_layers_count_across_batches(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-dup-listener"))
    raw, records = f"{paths.root}/raw", _records(spark).limit(50)
    records.write.parquet(raw)
    queries, listener = start_layers(
        spark, read_raw_stream(spark, path=raw), paths, rules, trigger={"processingTime": "1 second"}, gold_modes=(), state_partitions=2,
        duplicate_horizon="24 hours",
    )
    try:
        for again in range(2):
            for q in queries:
                q.processAllAvailable()
            if not again:
                records.limit(20).write.mode("append").parquet(raw)
        for q in queries:
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()
        listener.flush(spark, paths.metrics)
        spark.streams.removeListener(listener)
    found = {tuple(r) for r in duplicates_by_layer(read_metrics(spark, paths.metrics)).collect()}
    assert found == {("bronze_duplicates", 70, 20), ("silver_duplicates", 70, 20)}


def test_sketches_of_parts_answer_for_their_union(spark):
    df = spark.range(50_000).select((F.col("id") % 20_000).cast("string").alias("event_id"), (F.col("id") % 7).alias("day"))
    sketches = distinct_sketches(df, "day").cache()
    (whole,) = distinct_over(sketches).collect()
    assert whole.rows == 50_000 and abs(whole.distinct_ids - 20_000) <= 4 * sketch_error() * 20_000
    for r in distinct_over(sketches.filter("day < 3"), "day").collect():
        exact = df.filter(F.col("day") == r.day).select("event_id").distinct().count()
        assert abs(r.distinct_ids - exact) <= 4 * sketch_error() * exact
    sketches.unpersist()


@pytest.mark.parametrize("lg_k", [10, 16])
def test_approximate_duplicates(spark, lg_k):
    df = spark.range(30_000).select(F.when(F.col("id") >= 10, (F.col("id") % 25_000).cast("string")).alias("event_id"))
    exact, near = duplicate_count(df).first(), duplicate_count(df, lg_k=lg_k).first()
    assert near.total == exact.total == 30_000
    assert abs(near.distinct_ids - exact.distinct_ids) <= 4 * sketch_error(lg_k) * exact.distinct_ids
    assert near.duplicates == near.total - near.distinct_ids
    empty = duplicate_count(df.filter("false"), lg_k=lg_k).first()
    assert (empty.total, empty.distinct_ids or 0) == (0, 0)
