import datetime as dt
import json

from strata.operators.health import metrics_summary, metrics_timeline, quarantine_total, recent_errors
from strata.sources.metrics import metrics_lines_from_events, read_metrics, write_metrics_log

from .conftest import SF_SMALL

LINES = [
    {"ts": 100, "layer": "bronze", "batch_id": 1, "row_count": 42, "error": None, "extra": {"k": "v"}},
    {"ts": 100, "layer": "silver", "batch_id": 1, "row_count": 40},
    {"ts": 160, "layer": "bronze", "batch_id": 2, "row_count": 0, "error": "boom"},
    {"ts": 0, "layer": "gold", "batch_id": 3, "row_count": 7, "error": ""},
    {"ts": 220, "batch_id": 4, "row_count": 5},
    {"ts": 220, "layer": "gold", "batch_id": 5, "error": "late"},
]


def _write(tmp_path, lines, bad=("{broken", "")):
    p = tmp_path / "metrics.jsonl"
    p.write_text("\n".join([json.dumps(x) for x in lines] + list(bad)) + "\n")
    return str(p)


def test_read_metrics_skips_bad_lines(spark, tmp_path):
    df = read_metrics(spark, _write(tmp_path, LINES))
    assert df.count() == len(LINES) == len(df.collect())
    assert df.filter("batch_id = 1 AND layer = 'bronze'").first().extra == {"k": "v"}


def test_missing_log_reads_empty(spark, tmp_path):
    assert read_metrics(spark, str(tmp_path / "absent")).count() == 0


def test_metrics_summary(spark, tmp_path):
    out = {r.layer: (r.batches, r.rows, r.errors) for r in metrics_summary(read_metrics(spark, _write(tmp_path, LINES))).collect()}
    assert out == {"bronze": (2, 42, 1), "silver": (1, 40, 0), "gold": (2, 7, 1), "unknown": (1, 5, 0)}


def test_metrics_timeline(spark, tmp_path):
    out = [tuple(r) for r in metrics_timeline(read_metrics(spark, _write(tmp_path, LINES))).collect()]
    t = lambda s: dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)
    assert out == [(t(100), 42, 40, 0, 0), (t(160), 0, 0, 0, 0), (t(220), 0, 0, 0, 0)]


def test_recent_errors_top_k(spark, tmp_path):
    df = read_metrics(spark, _write(tmp_path, LINES))
    assert [r.error for r in recent_errors(df).collect()] == ["late", "boom"]
    assert [r.error for r in recent_errors(df, 1).collect()] == ["late"]


def test_derived_log_round_trip(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = str(tmp_path / "log")
    write_metrics_log(metrics_lines_from_events(ev), path)
    assert spark.read.text(path).count() == ev.count() + ev.filter("event_id % 97 = 0").count()
    assert read_metrics(spark, path).count() == ev.count()


def test_quarantine_total_counts_each_layer(spark):
    b = spark.createDataFrame([(1,), (2,)], "x int")
    s = spark.createDataFrame([(1,)], "x int")
    out = {r.layer: r.rows for r in quarantine_total({"bronze": b, "silver": s}).collect()}
    assert out == {"bronze": 2, "silver": 1, "all": 3}
    assert {r.layer: r.rows for r in quarantine_total({"bronze": b.limit(0), "silver": s.limit(0)}).collect()} == {"bronze": 0, "silver": 0, "all": 0}


def test_wrongly_typed_field_is_null_and_its_line_stays(spark, tmp_path):
    lines = [*LINES, {"ts": 1.5, "layer": "bronze", "batch_id": 9, "row_count": 7}, {"ts": 300, "layer": ["x"], "row_count": "many"}]
    df = read_metrics(spark, _write(tmp_path, lines, bad=("{broken", "", "[1]", "5")))
    assert df.count() == len(df.collect()) == len(lines)  # whichever columns are read
    row = df.filter("batch_id = 9").first()
    assert (row.ts, row.layer, row.row_count) == (None, "bronze", 7)
    assert {r.layer: r.batches for r in metrics_summary(df).collect()}["bronze"] == 3


def test_every_layer_has_a_place_in_the_timeline(spark, tmp_path):
    df = read_metrics(spark, _write(tmp_path, [{"ts": 100, "layer": "gold_live", "row_count": 7}, {"ts": 100, "layer": "bronze", "row_count": 1}]))
    (row,) = metrics_timeline(df).collect()
    assert (row.bronze, row.other) == (1, 7)
    (row,) = metrics_timeline(df, ["gold_live"]).collect()
    assert (row.gold_live, row.other) == (7, 1)
