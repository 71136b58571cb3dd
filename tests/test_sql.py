from strata.operators.kpi import (
    hourly_volume,
    kpis_by_event_type,
    kpis_by_event_type_full,
    kpis_by_event_type_weighted,
    total_events,
)
from strata.plans.backfill import backfill_layers
from strata.plans.sql import register_views
from strata.session import scratch_path
from strata.sources.events import event_rows, events_to_json
from strata.sources.tables import read_gold
from strata.streaming.layers import LayerPaths

from .conftest import SF_SMALL


def test_kpis_over_the_views_equal_kpis_over_the_tables(spark, rules):
    paths = LayerPaths(scratch_path(spark, "test-sql"))
    backfill_layers(spark, events_to_json(event_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet"))), paths, rules)
    names = register_views(spark, paths)
    assert {"bronze", "silver", "gold", "metrics", "quarantine"} <= set(names)
    gold, view = read_gold(spark, paths.gold), spark.table("gold")
    kpis = [total_events, kpis_by_event_type, kpis_by_event_type_full, kpis_by_event_type_weighted, hourly_volume]
    pairs = {f.__name__: (f(view), f(gold)) for f in kpis}
    for name, (over_view, over_table) in pairs.items():
        assert over_view.collect() == over_table.collect(), name
    q = spark.sql("SELECT layer, count(*) AS n FROM quarantine GROUP BY layer").collect()
    assert {r.layer: r.n for r in q} == {x: spark.table(f"quarantine_{x}").count() for x in ("bronze", "silver")}
