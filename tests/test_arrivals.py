"""Raw folders are landed in one pass over the input, part after part."""

import glob

from pyspark.sql import functions as F

from strata.plans.arrivals import land_deliveries, land_in_time_order
from strata.schemas import RAW
from strata.session import scratch_path
from strata.sources.events import event_rows, events_to_json, faulty_records

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _rows(spark, n):
    ids = spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 997 % 86400 + 1704067200).alias("ts"))
    events = ids.select("*", (F.col("event_id") % 7).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"))
    none = spark.createDataFrame([(None, None, None, None, None, None)] * 2, EVENTS)
    twice = events.filter("event_id % 50 = 3")
    return event_rows(events.unionByName(twice).unionByName(none))


def _landed(spark, path):
    return spark.read.schema(RAW).parquet(path)


def _files(folder):
    return glob.glob(folder.removeprefix("file:") + "/*.parquet")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_deliveries_are_the_distinct_records_and_the_rest(spark):
    rows, n = _rows(spark, 900), F.substring("event_id", 2, 20).cast("long")
    first = faulty_records(rows.filter(n % 41 != 7)).distinct()
    rest = faulty_records(rows).exceptAll(first)
    path = scratch_path(spark, "test-deliveries") + "/raw"
    late = ~F.coalesce(n % 41 != 7, F.lit(False))
    landing = land_deliveries(faulty_records(rows.withColumn("late", late), "late"), path)
    assert next(landing) == 0
    assert _same(_landed(spark, path), first)
    assert list(landing) == [1]
    assert _same(_landed(spark, path), first.unionByName(rest))


def test_delivery_without_records(spark):
    path = scratch_path(spark, "test-deliveries") + "/raw"
    records = spark.createDataFrame([("a", True), ("a", True)], "value string, late boolean")
    counts = [_landed(spark, path).count() for _ in land_deliveries(records, path)]
    assert counts == [0, 2]


def test_slices_are_written_in_one_pass(spark):
    rows = _rows(spark, 900)
    path = scratch_path(spark, "test-slices") + "/raw"
    seen = []
    for i in land_in_time_order(rows, path, 3, 2):
        seen.append((i, len(_files(path)), len(_files(f"{path}_landing/*"))))
    assert seen == [(0, 2, 4), (1, 4, 2), (2, 6, 0)]
    assert _same(_landed(spark, path), events_to_json(rows).select("value"))


def test_landed_files_have_small_row_groups(spark):
    import pyarrow.parquet as pq

    path = scratch_path(spark, "test-slices") + "/raw"
    rows = _rows(spark, 60_000).withColumn("source", F.base64(F.sha2(F.col("event_id"), 512).cast("binary")))
    list(land_in_time_order(rows.coalesce(1), path, 1, 1))
    (file,) = _files(path)
    assert pq.ParquetFile(file).num_row_groups > 1
