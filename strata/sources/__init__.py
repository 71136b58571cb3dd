"""Readers: driver tables, event-shaped rows, raw streams and the metrics log."""

from strata.sources.events import event_rows, events_to_json  # noqa: F401
from strata.sources.metrics import metrics_lines_from_events, read_metrics  # noqa: F401
from strata.sources.raw import read_raw_stream, write_raw_files  # noqa: F401
from strata.sources.tables import read_layer, read_or_empty, read_table  # noqa: F401
