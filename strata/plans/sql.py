"""Spark SQL over the layer tables: ``register_views`` exposes a deployment's
tables to ``spark.sql``. The KPI functions of :mod:`strata.operators.kpi` apply
to ``spark.table("gold")`` as to any Gold table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.schemas import GOLD
from strata.sources.metrics import read_metrics
from strata.sources.tables import read_bronze, read_dead_letters, read_gold_closed, read_gold_current, read_gold_live, read_layer, read_quarantine
from strata.streaming.layers import LayerPaths

def register_views(spark: SparkSession, paths: LayerPaths, gold: str = "final") -> list[str]:
    """Create temp views ``bronze``, ``silver``, ``gold`` (the closed hours
    with ``gold="final"``, closed and open hours with ``gold="current"``, or
    the latest live rows, compacted snapshot plus unfolded batches, with
    ``gold="live"``), ``metrics`` and
    ``quarantine`` (both layers; ``quarantine_bronze``/``_silver`` each).
    Returns the view names."""
    from strata.schemas import BRONZE, SILVER

    tables = {
        "final": lambda: read_gold_closed(spark, paths),
        "current": lambda: read_gold_current(spark, paths),
        "live": lambda: read_gold_live(spark, paths.gold_live, paths.gold_live_snapshot),
    }
    views = {
        "bronze": read_bronze(spark, paths.bronze),
        "dead_letters": read_dead_letters(spark, paths.bronze),
        "silver": read_layer(spark, paths.silver, SILVER),
        "gold": tables[gold](),
        "metrics": read_metrics(spark, paths.metrics),
    }
    quarantine = read_quarantine(spark, paths._p("quarantine"))
    for layer, df in quarantine.items():
        views[f"quarantine_{layer}"] = df
    both = None
    for layer, df in quarantine.items():
        part = df.selectExpr(f"'{layer}' AS layer", "rule", "event_id")
        both = part if both is None else both.unionByName(part)
    if both is not None:
        views["quarantine"] = both
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
