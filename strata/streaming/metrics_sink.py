"""Per-batch metric lines for the layer jobs.

Counts come from ``DataFrame.observe`` on the streaming plan, so they are
computed in the same pass that writes the layer; Spark reports them in each
query progress. Lines are written through Spark (JSON) to shared storage.
"""

from __future__ import annotations

import threading
import time
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from strata.schemas import METRICS


def _epoch_seconds(iso: str | None) -> int:
    if not iso:
        return int(time.time())
    return int(datetime.fromisoformat(iso.replace("Z", "+00:00")).timestamp())


#: Observation, beside the one of all rows, of the rows whose id was not seen before.
FIRST = "_first"


def progress_metrics(layer: str, progress, observation: str | None = None) -> tuple:
    """One metric row ``(ts, layer, batch_id, row_count, error, extra)`` from
    a ``StreamingQueryProgress``. ``row_count`` is the observed ``rows``
    count when an observation is named (its other counts go to ``extra``),
    else the input row count; a batch with no rows is noted as
    ``empty_batch``. A second observation of first sightings gives the
    duplicates."""
    observed = {}
    if observation and progress.observedMetrics and observation in progress.observedMetrics:
        observed = progress.observedMetrics[observation].asDict()
    rows = observed.pop("rows", None)
    first = (progress.observedMetrics or {}).get(f"{observation}{FIRST}")
    if rows is not None and first is not None:
        observed["duplicates"] = rows - first["rows"]
    late = sum(int(s.numRowsDroppedByWatermark or 0) for s in progress.stateOperators or ())
    if late:
        observed["late_rows"] = late
    if rows is None:
        rows = progress.numInputRows
    if rows == 0:
        observed["note"] = "empty_batch"
    extra = {k: str(v) for k, v in observed.items()} or None
    return (_epoch_seconds(progress.timestamp), layer, int(progress.batchId), int(rows), None, extra)


def error_metric(layer: str, batch_id: int | None, error: BaseException | str) -> tuple:
    return (int(time.time()), layer, batch_id, 0, str(error), None)


_write_lock = threading.Lock()


def write_batch_metrics(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Append metric rows (a handful per run) as one JSON file. Every line
    has every key; an absent value is written as null."""
    if rows:
        lines = spark.createDataFrame(rows, METRICS).coalesce(1)
        with _write_lock:  # two appends to one folder at a time would remove each other's temporary files
            lines.write.mode("append").option("ignoreNullFields", "false").json(path)


def _did_work(p) -> bool:
    # A no-data batch can still write: append-mode aggregates emit the
    # windows a newly advanced watermark has closed (seen in the observed
    # row count; file sinks do not report output rows).
    observed = (p.observedMetrics or {}).values()
    late = any((s.numRowsDroppedByWatermark or 0) > 0 for s in p.stateOperators or ())
    return late or p.numInputRows > 0 or any((m.asDict().get("rows") or 0) > 0 for m in observed)


def query_metrics(layer: str, batches, observation: str | None = None) -> list[tuple]:
    """Metric rows for the batches (progress objects, or a query whose
    recent progress is used) that read or wrote rows."""
    if isinstance(batches, StreamingQuery):
        batches = batches.recentProgress
    return [progress_metrics(layer, p, observation) for p in batches if _did_work(p)]


class MetricsListener(StreamingQueryListener):
    """For long-running jobs: buffer one metric row per progress event of
    the registered queries; ``flush`` writes them out. Terminations with an
    exception are recorded as error lines."""

    def __init__(self, layers: dict[str, tuple[str, str | None]]):
        # query name -> (layer, observation name)
        self.layers = layers
        self.queries: list[StreamingQuery] = []  # whose batches ``rows`` and ``flush`` wait for
        self._rows: list[tuple] = []
        self._names: dict[str, str] = {}
        self._last: dict[str, int] = {}  # newest batch of each query that was reported
        self._lock = threading.Lock()

    def onQueryStarted(self, event):
        with self._lock:
            self._names[str(event.id)] = event.name

    def onQueryProgress(self, event):
        p = event.progress
        with self._lock:
            if p.name in self.layers and _did_work(p):
                layer, obs = self.layers[p.name]
                self._rows.append(progress_metrics(layer, p, obs))
            self._last[str(p.id)] = int(p.batchId)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            with self._lock:
                name = self._names.get(str(event.id))
                layer = self.layers.get(name, (name or "unknown", None))[0]
                self._rows.append(error_metric(layer, self._last.get(str(event.id), -1) + 1, event.exception))

    def _settle(self, timeout: float = 10.0) -> None:
        """Wait until the batches that ``queries`` report have come here:
        their events are asynchronous."""
        due: dict[str, int] = {}
        for p in (p for q in self.queries for p in q.recentProgress):
            if p.name in self.layers and _did_work(p):
                due[str(p.id)] = max(int(p.batchId), due.get(str(p.id), -1))
        deadline = time.monotonic() + timeout
        while time.monotonic() < deadline:
            with self._lock:
                if all(self._last.get(i, -1) >= b for i, b in due.items()):
                    return
            time.sleep(0.05)

    @property
    def rows(self) -> list[tuple]:
        """The buffered lines, those of all batches reported so far."""
        self._settle()
        with self._lock:
            return list(self._rows)

    def flush(self, spark: SparkSession, path: str) -> None:
        self._settle()
        with self._lock:
            rows, self._rows = self._rows, []
        write_batch_metrics(spark, rows, path)
