"""Property tests: Spark operators against brute-force Python on random
small fixtures (NULLs, NaN, boundary values, hot keys)."""

import datetime as dt
import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.gold import gold_hourly
from strata.operators.health import metrics_summary
from strata.operators.quality import duplicate_count, quality_report, quarantine_rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

metric = st.one_of(
    st.none(),
    st.just(math.nan),
    st.sampled_from([-50.0, 0.0, 150.0, 10000.0, 86400.0, 1000000.0, -0.01, 10000.01]),
    st.floats(min_value=-1e6, max_value=2e6, allow_nan=False, allow_infinity=False),
)
duration = st.one_of(st.none(), st.integers(min_value=-10, max_value=100000))


def _violates(v, lo, hi):
    if v is None:
        return False
    if isinstance(v, float) and math.isnan(v):
        return True  # NaN sorts above every number in Spark
    return v < lo or v > hi


@SETTINGS
@given(st.lists(st.tuples(metric, metric, metric, duration), min_size=0, max_size=30))
def test_quality_report_and_quarantine_match_brute_force(spark, rules, rows):
    df = spark.createDataFrame(rows, "distance double, temperature double, amount double, duration int")
    ranges = rules["numeric_ranges"]
    fields = ["distance", "temperature", "amount", "duration"]
    want = {f: sum(_violates(r[i], ranges[f]["min"], ranges[f]["max"]) for r in rows) for i, f in enumerate(fields)}
    got = {r.field: r.out_of_range for r in quality_report(df, rules).collect()}
    assert got == want
    assert quarantine_rows(df, rules).count() == sum(want.values())


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "hot"])), max_size=40))
def test_duplicate_count_matches_brute_force(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "event_id string")
    r = duplicate_count(df).first()
    assert r.duplicates == len(ids) - len({i for i in ids if i is not None})


_base = dt.datetime(2024, 1, 1, 22, 0, 0)
event = st.tuples(
    st.one_of(st.none(), st.sampled_from(["e1", "e2", "e3"])),
    st.integers(min_value=0, max_value=4 * 3600 * 1000 - 1),  # ms after base: crosses midnight
    st.sampled_from(["trip", "sale"]),
    st.sampled_from(["device_1", "device_2"]),
    st.floats(min_value=-100, max_value=100, allow_nan=False),
    st.integers(min_value=0, max_value=100),
)


@SETTINGS
@given(st.lists(event, min_size=0, max_size=40))
def test_gold_hourly_matches_brute_force(spark, events):
    rows = []
    for eid, ms, et, src, x, d in events:
        t = _base + dt.timedelta(milliseconds=ms)
        ts = t.strftime("%Y-%m-%dT%H:%M:%S.") + f"{t.microsecond // 1000:03d}Z"
        rows.append((eid, ts, et, src, "ok", x, x, x, d, ""))
    df = spark.createDataFrame(
        rows,
        "event_id string, timestamp string, event_type string, source string, status string, "
        "distance double, temperature double, amount double, duration int, note string",
    )
    groups = defaultdict(list)
    for eid, ms, et, src, x, d in events:
        t = _base + dt.timedelta(milliseconds=ms)
        groups[(t.date(), t.hour, et, src)].append((eid, x, d))
    want = {
        k: (sum(e is not None for e, _, _ in v), min(x for _, x, _ in v), max(d for _, _, d in v), sum(x for _, x, _ in v) / len(v))
        for k, v in groups.items()
    }
    got = {
        (r.date_hour, r.hour, r.event_type, r.source): (r.event_count, r.min_distance, r.max_duration, r.avg_temperature)
        for r in gold_hourly(df).collect()
    }
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][:3] == want[k][:3]
        assert math.isclose(got[k][3], want[k][3], rel_tol=1e-9, abs_tol=1e-9)


line = st.fixed_dictionaries(
    {},
    optional={
        "layer": st.sampled_from(["bronze", "silver", "gold"]),
        "row_count": st.integers(min_value=0, max_value=1000),
        "error": st.sampled_from(["", "boom"]),
    },
)


@SETTINGS
@given(st.lists(line, max_size=25))
def test_metrics_summary_matches_dict_semantics(spark, lines):
    df = spark.createDataFrame(
        [(m.get("layer"), m.get("row_count"), m.get("error")) for m in lines],
        "layer string, row_count long, error string",
    )
    want: dict = {}
    for m in lines:
        s = want.setdefault(m.get("layer", "unknown"), [0, 0, 0])
        s[0] += 1
        s[1] += m.get("row_count", 0)
        s[2] += bool(m.get("error"))
    got = {r.layer: [r.batches, r.rows, r.errors] for r in metrics_summary(df).collect()}
    assert got == want
