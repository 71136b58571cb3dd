from pyspark.sql import functions as F

from strata.schemas import GOLD_LIVE
from strata.session import scratch_path
from strata.sources.tables import read_layer
from strata.streaming.compaction import compact_live_gold, read_live_current
from strata.streaming.folders import mark_done


def _live_batch(spark, path, batch_id, n_hours, count, done=True):
    """One live Gold batch with one key in each of ``n_hours`` event hours."""
    i = F.col("id")
    known = {
        "date_hour": F.date_add(F.to_date(F.lit("2024-01-01")), (i / 24).cast("int")),
        "hour": (i % 24).cast("int"),
        "event_type": F.lit("click"),
        "source": F.lit("device_1"),
        "status": F.lit("completed"),
        "event_count": F.lit(count).cast("long"),
        "batch_id": F.lit(batch_id).cast("long"),
    }
    cols = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in GOLD_LIVE.fields]
    spark.range(n_hours).select(*cols).write.mode("append").partitionBy("batch_id").parquet(path)
    if done:
        mark_done(spark, path, batch_id)


def test_compaction_over_hundreds_of_hours(spark):
    root = scratch_path(spark, "test-compact-hours")
    live, snap = f"{root}/live", f"{root}/snapshot"
    _live_batch(spark, live, 0, 400, 1)
    assert compact_live_gold(spark, live, snap) == 0
    _live_batch(spark, live, 1, 400, 2)  # every hour changes again
    _live_batch(spark, live, 2, 10, 3)  # and the first ten once more
    assert compact_live_gold(spark, live, snap) == 2
    current = read_live_current(spark, live, snap)
    counts = {r.event_count: r.n for r in current.groupBy("event_count").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {2: 390, 3: 10}
    assert read_layer(spark, snap, GOLD_LIVE).count() == 400  # one row per key


def test_a_batch_without_its_mark_is_not_folded(spark):
    root = scratch_path(spark, "test-compact-mark")
    live, snap = f"{root}/live", f"{root}/snapshot"
    _live_batch(spark, live, 0, 30, 1)
    _live_batch(spark, live, 1, 5, 2, done=False)  # still being written
    assert compact_live_gold(spark, live, snap) == 0
    assert [r.batch_id for r in read_layer(spark, live, GOLD_LIVE).select("batch_id").distinct().collect()] == [1]
    mark_done(spark, live, 1)
    assert compact_live_gold(spark, live, snap) == 1
    counts = {r.event_count: r.n for r in read_live_current(spark, live, snap).groupBy("event_count").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {2: 5, 1: 25}


def test_untouched_hours_are_read_without_a_merge(spark):
    root = scratch_path(spark, "test-live-read")
    live, snap = f"{root}/live", f"{root}/snapshot"
    _live_batch(spark, live, 0, 100, 1)
    compact_live_gold(spark, live, snap)
    _live_batch(spark, live, 1, 3, 2)
    plan = read_live_current(spark, live, snap)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    assert plan.count("max_by") <= 4  # the merge is planned over touched hours and the tail only
    assert read_live_current(spark, live, snap).count() == 100


def test_a_read_goes_on_during_a_compaction(spark):
    root = scratch_path(spark, "test-isolated")
    live, snap = f"{root}/live", f"{root}/snapshot"
    by_count = lambda df: {r.event_count: r.n for r in df.groupBy("event_count").agg(F.count(F.lit(1)).alias("n")).collect()}
    _live_batch(spark, live, 0, 50, 1)
    compact_live_gold(spark, live, snap, grace=3600)
    _live_batch(spark, live, 1, 20, 2)
    resolved = read_live_current(spark, live, snap)  # reads batch 1 beside version 0
    assert compact_live_gold(spark, live, snap, grace=3600) == 1
    _live_batch(spark, live, 2, 10, 3)
    assert compact_live_gold(spark, live, snap, grace=3600) == 2
    assert by_count(resolved) == {2: 20, 1: 30}  # opened only now
    assert by_count(read_live_current(spark, live, snap)) == {3: 10, 2: 10, 1: 30}
    later = read_live_current(spark, live, snap)
    assert compact_live_gold(spark, live, snap) is None  # nothing to fold, no grace: what was superseded goes
    assert by_count(later) == {3: 10, 2: 10, 1: 30}
    assert read_layer(spark, snap, GOLD_LIVE).count() == 50 and read_layer(spark, live, GOLD_LIVE).count() == 0


def test_a_run_that_dies_before_it_publishes_is_not_seen(spark):
    from strata.streaming import versions

    root = scratch_path(spark, "test-dead-run")
    live, snap = f"{root}/live", f"{root}/snapshot"
    _live_batch(spark, live, 0, 10, 1)
    compact_live_gold(spark, live, snap)
    _live_batch(spark, live, 1, 5, 2)
    # The next run wrote its hours and took its number, and no more.
    fs, folder = versions.hadoop_path(spark, f"{versions.lists_root(snap)}/1=1")
    fs.mkdirs(folder)
    rows = read_layer(spark, live, GOLD_LIVE).withColumn("event_count", F.lit(99).cast("long")).withColumn("version", F.lit(1).cast("long"))
    rows.write.mode("append").partitionBy("date_hour", "hour", "version").parquet(snap)
    want = {(0, 2), (5, 1)}
    hours = lambda: {(r.hour, r.event_count) for r in read_live_current(spark, live, snap).filter("hour IN (0, 5)").collect()}
    assert hours() == want
    assert compact_live_gold(spark, live, snap) == 1
    assert versions.published(spark, snap).version == 2
    assert hours() == want and read_layer(spark, snap, GOLD_LIVE).count() == 10


def test_hours_and_their_rows_are_replaced_together(spark):
    from strata.schemas import GOLD
    from strata.streaming.versions import hours_in_force, read_hours, replace_hours

    root = f"{scratch_path(spark, 'test-hours')}/t"
    assert read_hours(spark, root, GOLD).count() == 0 == hours_in_force(spark, root).count()
    live = f"{root}-live"
    _live_batch(spark, live, 0, 48, 1)
    rows = read_layer(spark, live, GOLD_LIVE).drop("batch_id")
    assert replace_hours(spark, root, rows, rows, 7) == 0
    gone = rows.filter("date_hour = DATE '2024-01-02'")
    assert replace_hours(spark, root, rows.filter("false"), gone, 8) == 1  # hours without rows
    assert read_hours(spark, root, GOLD).count() == 24 and hours_in_force(spark, root).count() == 48
    plan = read_hours(spark, root, GOLD).filter("date_hour = DATE '2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "concat_ws" in plan.split("PartitionFilters: [")[1].split("]")[0]
