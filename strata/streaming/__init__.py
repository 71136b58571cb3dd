"""Structured Streaming jobs for the three layers, and their metrics."""

from strata.streaming.layers import (  # noqa: F401
    LayerPaths,
    await_layers,
    bronze_split_streams,
    bronze_stream,
    duplicate_stream,
    gold_final_stream,
    gold_live_stream,
    reset_layer,
    run_layers,
    silver_quarantine_stream,
    silver_stream,
    start_layers,
    supervise_layers,
)
from strata.streaming.compaction import compact_live_gold, read_live_current  # noqa: F401
from strata.streaming.metrics_sink import MetricsListener, progress_metrics, write_batch_metrics  # noqa: F401
