import glob
import os

import pytest
from pyspark.sql import functions as F

from strata.operators.gold import gold_hourly, gold_latest
from strata.operators.silver import silver_flatten
from strata.schemas import GOLD, GOLD_LIVE, SILVER
from strata.session import scratch_path
from strata.sources.events import event_rows
from strata.sources.metrics import read_metrics
from strata.plans.arrivals import land_in_time_order
from strata.sources.raw import read_raw_stream, write_raw_files
from strata.sources.tables import read_layer
from strata.streaming.layers import LayerPaths, await_layers, run_layers

from .conftest import SF_SMALL

KEY = ["date_hour", "hour", "event_type", "source", "status"]


def _rows(spark):
    return event_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet"))


def _run(spark, paths, raw_path, rules):
    run_layers(spark, read_raw_stream(spark, path=raw_path), paths, rules, gold_modes=("final", "live"), state_partitions=4)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def layered(spark):
    from strata.functions.rules import load_rules

    rules = load_rules()
    paths = LayerPaths(scratch_path(spark, "test-layers"))
    raw = f"{paths.root}/raw"
    for _ in land_in_time_order(_rows(spark), raw, 3):
        _run(spark, paths, raw, rules)
    return paths, raw, rules


def test_stream_layers_equal_batch(spark, layered):
    paths, _, _ = layered
    rows = _rows(spark)
    silver = read_layer(spark, paths.silver, SILVER)
    assert _same(silver, silver_flatten(rows))
    batch_gold = gold_hourly(silver_flatten(rows), created_at=False)
    live = gold_latest(read_layer(spark, paths.gold_live, GOLD_LIVE)).select(*batch_gold.columns)
    assert _same(live, batch_gold)
    # several batches really happened, so some keys have more than one version
    assert read_layer(spark, paths.gold_live, GOLD_LIVE).select("batch_id").distinct().count() >= 3


def test_final_gold_holds_closed_windows_once(spark, layered):
    paths, _, _ = layered
    final = read_layer(spark, paths.gold, GOLD).drop("created_at")
    assert final.groupBy(*KEY).count().filter("count > 1").count() == 0
    batch_gold = gold_hourly(silver_flatten(_rows(spark)), created_at=False)
    wm = (
        silver_flatten(_rows(spark)).select(F.max(F.try_to_timestamp("timestamp")) - F.expr("INTERVAL 25 HOURS")).first()[0]
    )
    window_end = F.expr("CAST(date_hour AS TIMESTAMP) + make_interval(0, 0, 0, 0, hour + 1, 0, 0)")
    closed = batch_gold.filter(window_end <= F.lit(wm))
    assert 0 < closed.count() < batch_gold.count()
    assert _same(final.select(*batch_gold.columns), closed)


def test_metric_lines_count_every_row(spark, layered):
    paths, _, _ = layered
    m = read_metrics(spark, paths.metrics)
    n = _rows(spark).count()
    sums = {r.layer: r.rows for r in m.groupBy("layer").agg(F.sum("row_count").alias("rows")).collect()}
    assert sums["bronze"] == n and sums["silver"] == n
    assert m.filter("layer = 'bronze'").count() == 3  # one line per batch
    extra = m.filter("layer = 'silver'").select(F.explode("extra")).groupBy("key").agg(F.sum(F.col("value").cast("long"))).collect()
    assert {k for k, _ in extra} == {"distance", "temperature", "amount", "duration"}


def test_rerun_without_new_input_changes_nothing(spark, layered):
    paths, raw, rules = layered
    before = read_layer(spark, paths.silver, SILVER).count()
    _run(spark, paths, raw, rules)
    assert read_layer(spark, paths.silver, SILVER).count() == before


def test_replayed_batch_is_not_duplicated(spark, rules):
    """Crash between sink write and commit: drop the last commit file and
    restart; the file sink's log hides the first attempt."""
    paths = LayerPaths(scratch_path(spark, "test-replay"))
    raw = f"{paths.root}/raw"
    write_raw_files(_rows(spark), raw, 2)
    _run(spark, paths, raw, rules)
    n_silver = read_layer(spark, paths.silver, SILVER).count()
    ck = paths.checkpoint("silver").replace("file:", "")
    commits = sorted(glob.glob(os.path.join(ck, "commits", "[0-9]*")), key=lambda p: int(os.path.basename(p)))
    last = commits[-1]
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    _run(spark, paths, raw, rules)
    assert read_layer(spark, paths.silver, SILVER).count() == n_silver == 1000


def test_late_rows_behind_watermark_are_dropped(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-late"))
    raw = f"{paths.root}/raw"
    rows = _rows(spark)
    recent = rows.filter("timestamp >= '2024-01-20'")
    old = rows.filter("timestamp < '2024-01-10'")
    write_raw_files(recent, raw, 1)
    _run(spark, paths, raw, rules)
    closed_before = read_layer(spark, paths.gold, GOLD).count()
    write_raw_files(old, raw, 1)
    _run(spark, paths, raw, rules)
    # the old rows reach Silver but are behind the watermark for Gold
    assert read_layer(spark, paths.silver, SILVER).count() == recent.count() + old.count()
    gold = read_layer(spark, paths.gold, GOLD)
    assert gold.count() == closed_before
    assert gold.filter("date_hour < '2024-01-10'").count() == 0


def test_failed_batch_is_recorded_and_retried(spark, tmp_path):
    paths = LayerPaths(scratch_path(spark, "test-fail"))
    src = str(tmp_path / "src")
    spark.range(10).write.parquet(src)
    state = {"calls": 0}
    out = str(tmp_path / "out")

    def flaky(df, batch_id):
        state["calls"] += 1
        if state["calls"] == 1:
            raise RuntimeError("disk full")
        df.write.mode("append").parquet(out)

    def start():
        return (
            spark.readStream.schema("id long").parquet(src).writeStream.foreachBatch(flaky)
            .option("checkpointLocation", paths.checkpoint("flaky")).trigger(availableNow=True).start()
        )

    with pytest.raises(Exception):
        await_layers(spark, paths, [("silver", start(), None)])
    errors = read_metrics(spark, paths.metrics).filter("error IS NOT NULL").collect()
    assert len(errors) == 1 and "disk full" in errors[0].error and errors[0].layer == "silver"
    await_layers(spark, paths, [("silver", start(), None)])
    assert spark.read.parquet(out).count() == 10  # the failed batch was not lost


def test_long_running_layers_with_listener(spark, rules):
    from strata.streaming.layers import start_layers

    paths = LayerPaths(scratch_path(spark, "test-continuous"))
    raw = f"{paths.root}/raw"
    rows = _rows(spark)
    write_raw_files(rows, raw, 2)
    queries, listener = start_layers(
        spark, read_raw_stream(spark, path=raw), paths, rules, trigger={"processingTime": "1 second"}, state_partitions=4
    )
    try:
        for q in queries:  # upstream first, so each layer sees the last one's files
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()
        # progress events reach the listener asynchronously
        import time

        deadline = time.time() + 20
        while time.time() < deadline and {r[1] for r in listener.rows} < {"bronze", "silver"}:
            time.sleep(0.2)
        spark.streams.removeListener(listener)
    listener.flush(spark, paths.metrics)
    assert read_layer(spark, paths.silver, SILVER).count() == rows.count()
    m = read_metrics(spark, paths.metrics)
    sums = {r.layer: r.rows for r in m.groupBy("layer").agg(F.sum("row_count").alias("rows")).collect()}
    assert sums.get("bronze") == rows.count() and sums.get("silver") == rows.count()


def test_gold_metric_lines_count_written_windows(spark, layered):
    paths, _, _ = layered
    m = read_metrics(spark, paths.metrics).filter("layer = 'gold'")
    written = read_layer(spark, paths.gold, GOLD).count()
    assert m.agg(F.sum("row_count")).first()[0] == written


def test_gold_on_rocksdb_state(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-rocksdb"))
    raw = f"{paths.root}/raw"
    rows = _rows(spark)
    write_raw_files(rows, raw, 1)
    run_layers(spark, read_raw_stream(spark, path=raw), paths, rules, gold_modes=("live",), state_partitions=2, rocksdb=True)
    live = gold_latest(read_layer(spark, paths.gold_live, GOLD_LIVE))
    batch = gold_hourly(silver_flatten(rows), created_at=False)
    assert _same(live.select(*batch.columns), batch)
    # the session keeps its own settings
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or "")


def test_duplicate_metrics_per_batch(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-dups"))
    raw = f"{paths.root}/raw"
    rows = _rows(spark)
    dup = rows.limit(7)  # the same seven events delivered twice
    write_raw_files(rows, raw, 1)
    write_raw_files(dup, raw, 1)
    run_layers(spark, read_raw_stream(spark, path=raw), paths, rules, gold_modes=(), duplicate_metrics=True)
    m = read_metrics(spark, paths.metrics).filter("layer LIKE '%_duplicates'").collect()
    got = {(r.layer, int(r.extra["duplicates"]), r.row_count) for r in m}
    assert got == {("bronze_duplicates", 7, 1007), ("silver_duplicates", 7, 1007)}


def test_stream_quarantine_matches_batch(spark, layered):
    from strata.operators.quality import quarantine_rows
    from strata.sources.tables import read_quarantine

    paths, _, rules = layered
    q = read_quarantine(spark, f"{paths.root}/quarantine")
    expected = quarantine_rows(silver_flatten(_rows(spark)), rules)
    assert _same(q["silver"].select(*expected.columns), expected)
    assert q["bronze"].count() == expected.count()
    assert set(q["bronze"].columns) >= {"metrics", "extra", "distance", "rule"}


def test_empty_input_runs_clean(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-empty"))
    raw = f"{paths.root}/raw"
    write_raw_files(_rows(spark).limit(0), raw, 1)
    run_layers(spark, read_raw_stream(spark, path=raw), paths, rules, gold_modes=("final", "live"), state_partitions=2)
    assert read_layer(spark, paths.silver, SILVER).count() == 0
    assert read_layer(spark, paths.gold, GOLD).count() == 0
    assert read_metrics(spark, paths.metrics).count() == 0


def test_live_gold_compaction_keeps_current_rows(spark, rules):
    import os

    from strata.streaming.compaction import compact_live_gold, read_live_current

    paths = LayerPaths(scratch_path(spark, "test-compact"))
    raw = f"{paths.root}/raw"
    rows = _rows(spark)
    live, snap = paths.gold_live, paths.gold_live_snapshot
    live_batches = lambda: read_layer(spark, live, GOLD_LIVE).select("batch_id").distinct().count()
    local = snap.removeprefix("file:")
    def dated():  # files per (date, hour) partition of the snapshot
        out = {}
        for top, _, files in os.walk(local):
            rel = os.path.relpath(top, local)
            if rel.count("=") == 2:
                out[rel] = sorted(f for f in files if f.endswith(".parquet"))
        return out

    assert compact_live_gold(spark, live, snap) is None  # nothing written yet
    folded, before = [], {}
    for i in land_in_time_order(rows, raw, 4):
        run_layers(spark, read_raw_stream(spark, path=raw), paths, rules, gold_modes=("live",), state_partitions=2)
        if i == 2:
            tail_dates = {
                f"date_hour={r[0]}/hour={r[1]}"
                for r in read_layer(spark, live, GOLD_LIVE).select("date_hour", "hour").distinct().collect()
            }
            before = dated()
        if i in (1, 2):
            folded.append(compact_live_gold(spark, live, snap))
            assert live_batches() == 0  # folded partitions are gone
            assert compact_live_gold(spark, live, snap) is None  # nothing new
    assert folded[0] < folded[1]
    after = dated()
    # hours the second run did not touch keep their files
    assert set(before) - tail_dates
    assert all(after[d] == files for d, files in before.items() if d not in tail_dates)
    assert live_batches() >= 1  # the last slice is read from the live batches
    batch = gold_hourly(silver_flatten(rows), created_at=False)
    assert _same(read_live_current(spark, live, snap).select(*batch.columns), batch)

    # A run that died after staging, before its swap: the next run applies it.
    from strata.operators.gold import gold_latest

    current = gold_latest(read_layer(spark, snap, GOLD_LIVE).unionByName(read_layer(spark, live, GOLD_LIVE)), keep_version=True)
    current.write.parquet(f"{snap}_staging/upto=999")
    compact_live_gold(spark, live, snap)
    assert not os.path.exists(f"{local}_staging/upto=999")
    assert live_batches() == 0
    assert _same(read_live_current(spark, live, snap).select(*batch.columns), batch)
    assert read_layer(spark, snap, GOLD_LIVE).count() == batch.count()  # one row per key


def test_silver_quarantine_filter_reaches_the_scan(spark, rules):
    from strata.operators.quality import quarantine_rows
    from strata.streaming.layers import silver_quarantine_stream

    paths = LayerPaths(scratch_path(spark, "test-silver-q"))
    silver = silver_flatten(_rows(spark))
    silver.write.parquet(paths.silver)
    q = silver_quarantine_stream(spark, paths, rules)
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    assert "PushedFilters: [Or(" in plan and "LessThan(distance" in plan
    got = spark.read.parquet(paths.quarantine("silver"))
    expected = quarantine_rows(silver, rules)
    assert _same(got.select(*expected.columns), expected)


def test_supervise_flushes_compacts_and_stops(spark, rules):
    from strata.streaming.compaction import read_live_current
    from strata.streaming.layers import start_layers, supervise_layers

    paths = LayerPaths(scratch_path(spark, "test-supervise"))
    raw = f"{paths.root}/raw"
    rows = _rows(spark)
    write_raw_files(rows, raw, 2)
    queries, listener = start_layers(
        spark, read_raw_stream(spark, path=raw), paths, rules, trigger={"processingTime": "1 second"},
        gold_modes=("final", "live"), state_partitions=2,
    )
    try:
        for q in queries:  # upstream first
            q.processAllAvailable()
        supervise_layers(spark, queries, listener, paths, flush_every=0.5, compact_every=0.5, run_for=3, poll=0.2)
    finally:
        spark.streams.removeListener(listener)
    assert not any(q.isActive for q in queries)
    assert read_layer(spark, paths.gold_live_snapshot, GOLD_LIVE).count() > 0  # compacted
    batch = gold_hourly(silver_flatten(rows), created_at=False)
    assert _same(read_live_current(spark, paths.gold_live, paths.gold_live_snapshot).select(*batch.columns), batch)
    layers = {r.layer for r in read_metrics(spark, paths.metrics).select("layer").distinct().collect()}
    assert {"bronze", "silver"} <= layers


def test_supervise_reraises_a_failed_query(spark):
    from strata.streaming.layers import supervise_layers
    from strata.streaming.metrics_sink import MetricsListener

    paths = LayerPaths(scratch_path(spark, "test-supervise-fail"))

    def boom(batch, batch_id):
        if batch_id >= 1:
            raise ValueError("bad batch")

    def rate(name, fn):
        return (
            spark.readStream.format("rate").option("rowsPerSecond", 5).load()
            .writeStream.queryName(name).foreachBatch(fn)
            .option("checkpointLocation", paths.checkpoint(name)).trigger(processingTime="200 milliseconds").start()
        )

    listener = MetricsListener({"failing": ("failing", None), "steady": ("steady", None)})
    spark.streams.addListener(listener)
    queries = [rate("failing", boom), rate("steady", lambda b, i: None)]
    try:
        with pytest.raises(Exception, match="bad batch"):
            supervise_layers(spark, queries, listener, paths, flush_every=60, compact_every=None, run_for=60, poll=0.2)
    finally:
        spark.streams.removeListener(listener)
    assert not any(q.isActive for q in queries)  # the steady query was stopped too
    errors = read_metrics(spark, paths.metrics).filter("coalesce(error, '') <> ''").collect()
    assert [r.layer for r in errors] == ["failing"] and "bad batch" in errors[0].error


def test_gold_output_files_bound_files_per_emission(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-outfiles"))
    raw = f"{paths.root}/raw"
    rows = _rows(spark)
    write_raw_files(rows, raw, 1)
    run_layers(
        spark, read_raw_stream(spark, path=raw), paths, rules, gold_modes=("final", "live"),
        state_partitions=4, output_files=1,
    )
    final = read_layer(spark, paths.gold, GOLD)
    per_date = final.groupBy("date_hour").agg(F.count_distinct("_metadata.file_path").alias("files")).collect()
    assert per_date and max(r.files for r in per_date) == 1  # one emission, one file per date
    live = read_layer(spark, paths.gold_live, GOLD_LIVE)
    per_batch = live.groupBy("batch_id").agg(F.count_distinct("_metadata.file_path").alias("files")).collect()
    assert max(r.files for r in per_batch) == 1
    batch = gold_hourly(silver_flatten(rows), created_at=False)
    assert _same(gold_latest(live).select(*batch.columns), batch)
