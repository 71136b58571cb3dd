"""Write docs/PLANS.md: the physical plans of the headline queries.

    python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.catalog import QUERIES  # noqa: E402
from strata.session import get_session  # noqa: E402

HEADLINE = {
    "gold_hourly": "partial aggregate before the shuffle; only used columns read",
    "kpis_by_event_type": "the written Gold table is read: one aggregation by event type, no exchange on the Gold keys",
    "kpis_by_event_type_dates": "date bounds as PartitionFilters",
    "gold_hourly_live": "untouched hours straight from the snapshot (anti join), max_by over touched hours and the tail only",
    "gold_hourly_final": "open hours: event_date as PartitionFilters and event_ts as PushedFilters on Silver, no parse of times",
    "silver_date_range": "event_date as PartitionFilters",
    "quality_report": "one pass, count_if per rule, single-row final",
    "quarantine_rows": "rule filter evaluated in the scan stage, explode without shuffle",
    "duplicate_count": "ids de-duplicated per map task before the shuffle",
    "metrics_timeline": "pivot as one conditional aggregate: one aggregation shuffle, then the sort",
    "recent_errors": "TakeOrderedAndProject (top-k), no full sort",
    "gold_backfill": "date_hour partition column read from the folder layout",
}


STREAMS = {
    "gold_final_stream": "partial aggregate before the state-store shuffle; the Silver scan reads only the columns Gold uses",
    "silver_quarantine_stream": "the rule OR pushed into the Silver file scan (row groups inside every range are skipped)",
}


def stream_plans(spark, sf_dir: str) -> list[str]:
    """Micro-batch plans of two streaming queries, run with ``availableNow``
    over a Silver table back-filled from the same events."""
    from strata.functions.rules import load_rules
    from strata.plans.backfill import backfill_layers
    from strata.plans.catalog import bronze_rows
    from strata.session import scratch_path
    from strata.sources.events import events_to_json
    from strata.streaming.layers import LayerPaths, gold_final_stream, silver_quarantine_stream

    rules = load_rules()
    src = LayerPaths(scratch_path(spark, "plans-src"))
    backfill_layers(spark, events_to_json(bronze_rows(spark, sf_dir)), src, rules)
    paths = LayerPaths(scratch_path(spark, "plans"))
    spark.read.parquet(src.silver).write.partitionBy("event_date").parquet(paths.silver)
    # Only the data batch, so the captured plan is the one that reads Silver
    # (a closing no-data batch would be the last execution otherwise).
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        started = {
            "gold_final_stream": gold_final_stream(spark, paths, state_partitions=8),
            "silver_quarantine_stream": silver_quarantine_stream(spark, paths, rules),
        }
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    out = []
    for name, query in started.items():
        query.awaitTermination()
        plan = query._jsq.explainInternal(False).strip()
        out += [f"## {name} (one micro-batch)", "", f"What to look for: {STREAMS[name]}.", "", "```", plan, "```", ""]
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("strata-plans", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        "# Physical plans of the headline queries",
        "",
        f"Generated by `scripts/explain_plans.py` on `{sf_dir}`.",
        "",
    ]
    for name, why in HEADLINE.items():
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        tree = plan.split("\n\n\n")[0]
        details = [
            line[:1500] for line in plan.splitlines()
            if line.startswith(("PushedFilters", "ReadSchema", "PartitionFilters", "Keys", "Functions", "Arguments"))
        ]
        out += [f"## {name}", "", f"What to look for: {why}.", "", "```", tree.strip(), "", *details, "```", ""]
    out += stream_plans(spark, sf_dir)
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
