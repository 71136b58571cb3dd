"""DataFrame -> DataFrame operators for every layer, quality checks, KPIs
and health reports. Each works on batch and (where Spark allows) streaming
DataFrames alike."""

from strata.operators.bronze import bronze_parse, with_flat_metrics  # noqa: F401
from strata.operators.gold import gold_hourly, gold_latest, gold_windows  # noqa: F401
from strata.operators.health import (  # noqa: F401
    metrics_summary,
    metrics_timeline,
    quarantine_files,
    quarantine_total,
    recent_errors,
)
from strata.operators.kpi import (  # noqa: F401
    hourly_volume,
    kpis_by_event_type,
    kpis_by_event_type_full,
    kpis_by_event_type_weighted,
    total_events,
)
from strata.operators.quality import (  # noqa: F401
    duplicate_count,
    quality_counts,
    quality_report,
    quarantine_rows,
    schema_check,
)
from strata.operators.silver import silver_flatten  # noqa: F401
