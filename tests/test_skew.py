"""Hot keys: one group holding a third of all rows must give exact results,
and the plan must combine it on each map task before the shuffle."""

from pyspark.sql import functions as F

from strata.operators.gold import gold_hourly, gold_latest
from strata.operators.quality import duplicate_count

N = 30_000


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _silver(spark):
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(0, N, 1, 8).select(
        F.when(hot, F.lit("e-hot")).otherwise(F.concat(F.lit("e"), i.cast("string"))).alias("event_id"),
        F.when(hot, F.lit("2024-01-01T10:15:00.000Z"))
        .otherwise(F.format_string("2024-01-01T%02d:30:00.000Z", (i % 24).cast("int")))
        .alias("timestamp"),
        F.when(hot, F.lit("click")).otherwise(F.lit("view")).alias("event_type"),
        F.when(hot, F.lit("device_1")).otherwise(F.format_string("device_%d", (i % 97).cast("int"))).alias("source"),
        F.lit("completed").alias("status"),
        (i % 100).cast("double").alias("distance"),
        F.lit(20.0).alias("temperature"),
        F.lit(1.0).alias("amount"),
        (i % 7).cast("int").alias("duration"),
        F.lit("").alias("note"),
    )


def test_hot_gold_key_is_exact_and_pre_combined(spark):
    gold = gold_hourly(_silver(spark), created_at=False)
    hot = gold.filter((F.col("source") == "device_1") & (F.col("event_type") == "click")).collect()
    assert len(hot) == 1 and hot[0].event_count == N // 3 and hot[0].hour == 10
    assert hot[0].min_distance == 0.0 and hot[0].max_distance == 99.0
    assert gold.agg(F.sum("event_count")).first()[0] == N
    plan = _plan(gold)
    assert "partial_count" in plan and plan.index("partial_count") > plan.index("Exchange")  # below it


def test_hot_duplicate_id_counts_exactly(spark):
    r = duplicate_count(_silver(spark), "event_id").first()
    assert (r.total, r.distinct_ids, r.duplicates) == (N, N - N // 3 + 1, N // 3 - 1)


def test_key_with_many_versions_keeps_the_latest(spark):
    # one Gold key rewritten in every one of 10,000 batches, plus a cold key
    versions = spark.range(0, 10_000, 1, 8).select(
        F.to_date(F.lit("2024-01-01")).alias("date_hour"),
        F.lit(10).alias("hour"),
        F.lit("click").alias("event_type"),
        F.lit("device_1").alias("source"),
        F.lit("completed").alias("status"),
        (F.col("id") + 1).alias("event_count"),
        F.col("id").alias("batch_id"),
    )
    cold = spark.createDataFrame([("2024-01-01", 11, "view", "device_2", "completed", 5, 3)], versions.columns).select(
        F.to_date("date_hour").alias("date_hour"), *[F.col(c) for c in versions.columns[1:]]
    )
    latest = gold_latest(versions.unionByName(cold)).orderBy("hour").collect()
    assert [(r.hour, r.event_count) for r in latest] == [(10, 10_000), (11, 5)]
    assert "partial_max_by" in _plan(gold_latest(versions))


def test_hot_timestamp_is_cut_across_raw_files(spark, tmp_path):
    from strata.sources.raw import write_raw_files
    from strata.sources.events import event_rows
    from .conftest import SF_SMALL

    # every event at the same instant: one range key for all rows
    rows = event_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet")).withColumn(
        "timestamp", F.lit("2024-01-01T10:00:00.000Z")
    )
    path = str(tmp_path / "raw")
    write_raw_files(rows, path, 4)
    per_file = spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()
    assert sum(r["count"] for r in per_file) == rows.count()
    assert len(per_file) == 4 and max(r["count"] for r in per_file) < rows.count() / 2
