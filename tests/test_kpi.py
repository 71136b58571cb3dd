import datetime as dt

from strata.operators.kpi import (
    hourly_volume,
    kpis_by_event_type,
    kpis_by_event_type_full,
    kpis_by_event_type_weighted,
    total_events,
)
from strata.schemas import GOLD


def _gold(spark, rows):
    full = []
    for d, h, et, n, avg in rows:
        full.append((d, h, et, "d1", "ok", n, avg, avg, avg, avg, avg, avg, avg, avg, avg, avg, 1, 1, None))
    return spark.createDataFrame(full, GOLD)


ROWS = [
    (dt.date(2024, 1, 1), 1, "a", 1, 10.0),
    (dt.date(2024, 1, 1), 2, "a", 3, 2.0),
    (dt.date(2024, 1, 2), 1, "b", 10, 1.005),
]


def test_total_events(spark):
    assert total_events(_gold(spark, ROWS)).first().total_events == 14
    assert total_events(spark.createDataFrame([], GOLD)).first().total_events == 0


def test_kpis_unweighted_mean_of_hourly_means(spark):
    out = kpis_by_event_type(_gold(spark, ROWS)).collect()
    assert [r.event_type for r in out] == ["b", "a"]  # by total desc
    a = out[1]
    assert a.total_events == 4 and a.avg_distance == 6.0  # (10 + 2) / 2
    assert kpis_by_event_type(_gold(spark, ROWS)).columns == [
        "event_type", "total_events", "avg_distance", "avg_temperature", "avg_amount"]
    assert "avg_duration" in kpis_by_event_type_full(_gold(spark, ROWS)).columns


def test_kpis_round_half_up(spark):
    b = kpis_by_event_type(_gold(spark, ROWS)).collect()[0]
    assert b.avg_distance == 1.01  # Spark rounds 1.005 half up on its decimal text


def test_kpis_weighted(spark):
    a = [r for r in kpis_by_event_type_weighted(_gold(spark, ROWS)).collect() if r.event_type == "a"][0]
    assert a.avg_distance == 4.0  # (10*1 + 2*3) / 4


def test_hourly_volume_sums_across_dates(spark):
    out = [tuple(r) for r in hourly_volume(_gold(spark, ROWS)).collect()]
    assert out == [(1, 11), (2, 3)]
