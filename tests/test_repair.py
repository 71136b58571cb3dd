"""Closed Gold hours that later rows belong to are rebuilt; dead letters keep their text."""

import glob

import pytest
from pyspark.sql import functions as F

from strata.operators.gold import gold_hourly
from strata.operators.silver import silver_flatten
from strata.schemas import GOLD, SILVER_TABLE
from strata.session import scratch_path
from strata.sources.events import event_rows, events_to_json, faulty_records
from strata.sources.metrics import read_metrics
from strata.sources.raw import read_raw_stream, write_raw_files
from strata.sources.tables import read_bronze, read_dead_letters, read_gold, read_gold_closed, read_gold_current, read_silver
from strata.streaming.layers import LayerPaths, reset_layer, run_layers
from strata.streaming.repair import repair_gold
from strata.streaming.versions import read_hours

from .conftest import SF_SMALL


def _rows(spark):
    return event_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet"))


def _run(spark, paths, rules, **options):
    raw = f"{paths.root}/raw"
    run_layers(spark, read_raw_stream(spark, path=raw), paths, rules, **{"gold_modes": ("final",), "state_partitions": 2, **options})


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _gold(rows):
    gold = gold_hourly(silver_flatten(rows), created_at=False)
    return gold.select(*[F.round(c, 6).alias(c) if c.startswith("avg_") else F.col(c) for c in gold.columns])


def _current(spark, paths, *dates):
    gold = read_gold_current(spark, paths, *dates).drop("created_at")
    return gold.select(*[F.round(c, 6).alias(c) if c.startswith("avg_") else F.col(c) for c in gold.columns])


@pytest.fixture(scope="module")
def late(spark):
    """Gold of all rows but every 17th, which come when the watermark is behind their hours."""
    from strata.functions.rules import load_rules

    rules, rows = load_rules(), _rows(spark)
    paths = LayerPaths(scratch_path(spark, "test-repair"))
    n = F.substring("event_id", 2, 20).cast("long")
    write_raw_files(rows.filter(n % 17 != 3), f"{paths.root}/raw", 2)
    _run(spark, paths, rules)
    return paths, rules, rows, rows.filter(n % 17 == 3)


def test_late_rows_reach_their_hours(spark, late):
    paths, rules, rows, held = late
    assert repair_gold(spark, paths) == []  # nothing came late yet
    write_raw_files(held, f"{paths.root}/raw", 1)
    _run(spark, paths, rules)
    assert not _same(_current(spark, paths), _gold(rows))
    before = read_gold_closed(spark, paths)  # resolved before the repair
    n_before = before.agg(F.sum("event_count")).first()[0]
    found = repair_gold(spark, paths)
    hours = held.select(F.to_date("timestamp").alias("d"), F.hour(F.to_timestamp("timestamp")).alias("h")).distinct().count()
    assert 0 < len(found) <= hours
    assert _same(_current(spark, paths), _gold(rows))
    assert before.agg(F.sum("event_count")).first()[0] == n_before
    day = "2024-01-05"
    assert _same(_current(spark, paths, day, day), _gold(rows).filter(F.col("date_hour") == day))
    assert repair_gold(spark, paths) == []


def test_one_late_row_rewrites_one_hour(spark, late):
    paths, rules, rows, _ = late
    repair_gold(spark, paths)
    row = rows.limit(1).withColumn("event_id", F.lit(None).cast("string"))  # no count of ids shows it
    row = row.withColumn("timestamp", F.lit("2024-01-03T04:05:06.000Z")).withColumn("metrics", F.col("metrics").withField("amount", F.lit(9e9)))
    events_to_json(row).write.mode("append").parquet(f"{paths.root}/raw")
    _run(spark, paths, rules)
    found = repair_gold(spark, paths)
    assert [(str(d), h) for d, h in found] == [("2024-01-03", 4)]
    newest = read_hours(spark, paths.gold_corrections, GOLD).filter("date_hour = DATE '2024-01-03' AND hour = 4")
    assert newest.agg(F.max("max_amount")).first()[0] == 9e9
    assert read_gold(spark, paths.gold).agg(F.max("max_amount")).first()[0] < 9e9  # the stream's own table is as it was


def test_a_repair_reads_only_dates_with_new_files(spark, late):
    paths = late[0]
    repair_gold(spark, paths)
    silver = read_silver(spark, paths.silver)
    newest = silver.agg(F.max(F.unix_millis("_metadata.file_modification_time"))).first()[0]
    plan = silver.filter(F.col("_metadata.file_modification_time") > F.timestamp_millis(F.lit(newest)))
    assert plan.count() == 0
    plan = read_silver(spark, paths.silver, "2024-01-05", "2024-01-05").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_open_hours_read_only_their_partitions(spark, late):
    plan = read_gold_current(spark, late[0])._jdf.queryExecution().executedPlan().toString()
    silver = next(x for x in plan.split("FileScan parquet")[1:] if "event_ts" in x.split("]")[0])
    assert "event_date" in silver.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_ts" in silver.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "try_to_timestamp" not in plan and "gettimestamp" not in plan


def test_reset_removes_corrections(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-repair-reset"))
    rows = _rows(spark)
    write_raw_files(rows.filter("timestamp >= '2024-01-20'"), f"{paths.root}/raw", 1)
    _run(spark, paths, rules)
    write_raw_files(rows.filter("timestamp < '2024-01-10'"), f"{paths.root}/raw", 1)
    _run(spark, paths, rules)
    assert repair_gold(spark, paths, "2024-01-02", "2024-01-03")
    closed = read_gold_closed(spark, paths)
    assert {str(r[0]) for r in closed.filter("date_hour < DATE '2024-01-10'").select("date_hour").distinct().collect()} == {"2024-01-02", "2024-01-03"}
    assert repair_gold(spark, paths)
    assert _same(_current(spark, paths), _gold(rows.filter("timestamp >= '2024-01-20' OR timestamp < '2024-01-10'")))
    assert paths.gold_corrections in reset_layer(spark, paths, "gold")
    assert read_gold_closed(spark, paths).count() == 0


@pytest.mark.parametrize("drop_bad", [False, True])
def test_dead_letters_keep_their_text(spark, rules, drop_bad):
    paths = LayerPaths(scratch_path(spark, "test-dead"))
    records = faulty_records(_rows(spark))
    other = spark.createDataFrame([('{"event_id": "x", "metrics": 7}',), ("[1, 2]",), ("",), (None,), ("{}",), ('{"a": 1} trailing {',)], "value string")
    records.unionByName(other).write.parquet(f"{paths.root}/raw")
    _run(spark, paths, rules, drop_bad=drop_bad)
    n = records.count() + 6
    dead = sorted(r[0] for r in read_dead_letters(spark, paths.bronze).collect())
    cut = [r[0] for r in records.filter("length(value) = 20").collect()]
    assert len(dead) - len(cut) in (1, 2, 3) and set(cut) <= set(dead) and "[1, 2]" in dead
    (line,) = read_metrics(spark, paths.metrics).filter("layer = 'bronze'").agg(
        F.sum("row_count").alias("rows"), F.sum(F.col("extra")["dead_letters"].cast("long")).alias("dead")
    ).collect()
    assert (line.rows, line.dead) == (n, len(dead))
    if not drop_bad:
        assert read_bronze(spark, paths.bronze).count() == n - len(dead)
    assert read_bronze(spark, paths.bronze).filter("event_id = 'x'").count() == 1  # one wrong field leaves the others
    # no other reader opens the dead letters
    plan = read_bronze(spark, paths.bronze)._jdf.queryExecution().executedPlan().toString()
    assert "parsed" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_silver_is_typed_and_partitioned_by_date(spark, late):
    paths = late[0]
    silver = read_silver(spark, paths.silver)
    assert silver.schema == SILVER_TABLE
    assert glob.glob(f"{paths.silver.removeprefix('file:')}/event_date=2024-01-05/*.parquet")
    assert silver.filter("event_ts IS DISTINCT FROM try_to_timestamp(timestamp) OR event_date IS DISTINCT FROM to_date(event_ts)").count() == 0
