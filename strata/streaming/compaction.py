"""Compaction of the live Gold table.

Live Gold gains one ``batch_id`` partition per micro-batch, holding the
cumulative rows of the keys that batch changed. Left alone, every read of
the current rows (:func:`strata.operators.gold.gold_latest`) scans all the
batches ever written. Compaction folds the live batches into a snapshot, a
table of whole hours (:mod:`strata.streaming.versions`) that keeps one row per
key (with the ``batch_id`` of its version), and later deletes the folded batch
partitions.

Each run touches only the event hours present in the live batches it
folds: mostly the last hour or two, and at most the watermark horizon when
events arrive late. It reads the snapshot partitions of those hours
(partition pruning), collapses them with the batches (a pre-aggregated
``max_by``) and publishes them as a new version. A run costs the size of the
touched hours, not the size of the history. The merged rows are range-split on
the Gold key, so each writer covers a run of consecutive hours (few files per
hour) and a hot hour is cut across writers.

The published list of hours carries the newest folded batch, so a reader knows
from one file which batches to read beside the snapshot. Readers are isolated:
what they resolved stays until it has been superseded for ``grace`` seconds.
Current rows are right however far a run got: an unpublished run is not seen,
and its batches are still there for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.gold import gold_latest
from strata.schemas import GOLD_KEYS, GOLD_LIVE
from strata.sources.tables import read_layer
from strata.streaming.folders import delete, done_root, hadoop_path, numbered_folders
from strata.streaming.versions import HOUR, published, read_hours, replace_hours, sweep


def _staging_root(snapshot_path: str) -> str:
    """Where runs of earlier releases staged their rows."""
    return snapshot_path.rstrip("/") + "_staging"


def _in_hours(snapshot: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Snapshot rows whose hour occurs in ``rows`` (``left_semi``) or does not
    (``left_anti``). The join is on the partition columns, so Spark prunes the
    snapshot's folders by the hours found at run time. The hours (as many as
    there are in the batches, whatever the number of rows) are broadcast, so the
    snapshot is not shuffled."""
    hours = F.broadcast(rows.select(*HOUR).distinct())
    same = [snapshot[c].eqNullSafe(hours[c]) if how == "left_anti" else snapshot[c] == hours[c] for c in HOUR]
    return snapshot.join(hours, same[0] & same[1], how)


def _unfolded(spark: SparkSession, live_path: str, snapshot_path: str) -> DataFrame:
    """Rows of the live batches after the newest one in the snapshot (a partition filter)."""
    run = published(spark, snapshot_path)
    live = read_layer(spark, live_path, GOLD_LIVE)
    return live.filter(F.col("batch_id") > run.mark) if run else live


def read_live_current(spark: SparkSession, live_path: str, snapshot_path: str) -> DataFrame:
    """Current Gold rows from the snapshot plus the live batches not yet
    folded. Hours that no such batch touches come straight from the snapshot,
    which already has one row per key; only touched hours are collapsed. A
    compaction beside the read changes nothing in it."""
    live = _unfolded(spark, live_path, snapshot_path)
    snapshot = read_hours(spark, snapshot_path, GOLD_LIVE)
    untouched = _in_hours(snapshot, live, "left_anti").drop("batch_id")
    touched = _in_hours(snapshot, live, "left_semi")
    return untouched.unionByName(gold_latest(touched.unionByName(live)))


def compact_live_gold(spark: SparkSession, live_path: str, snapshot_path: str, drop_folded: bool = True, grace: float = 0.0) -> int | None:
    """Fold the live batches visible now into the snapshot; returns the
    newest folded batch id (None when there was nothing to fold).

    With ``drop_folded=False`` the folded batch partitions stay. ``grace``
    (seconds) is how long superseded hours and folded batches stay for readers
    that resolved them before: longer than the longest read."""
    batches = numbered_folders(spark, live_path, "batch_id")
    done = numbered_folders(spark, done_root(live_path), "batch_id")
    run = published(spark, snapshot_path)
    folded = run.mark if run else -1
    # Only batches marked as whole are folded (a listing, no job).
    ready = sorted(b for b in batches if b in done and b > folded)
    staged = {n: s for n, s in numbered_folders(spark, _staging_root(snapshot_path), "upto").items() if _whole(spark, s)}
    newest = None
    if ready or staged:
        tail = read_layer(spark, live_path, GOLD_LIVE).filter(F.col("batch_id").isin(ready))
        for folder in staged.values():  # of a run that died in an earlier release
            tail = tail.unionByName(spark.read.schema(GOLD_LIVE).parquet(folder))
        touched = _in_hours(read_hours(spark, snapshot_path, GOLD_LIVE), tail, "left_semi")
        merged = gold_latest(touched.unionByName(tail), keep_version=True)
        newest = max(ready, default=folded)
        replace_hours(spark, snapshot_path, merged.repartitionByRange(*GOLD_KEYS), tail.select(*HOUR), newest)
    for folder in numbered_folders(spark, _staging_root(snapshot_path), "upto").values():
        delete(spark, folder)
    upto = sweep(spark, snapshot_path, grace)
    if drop_folded:
        for b in sorted(b for b in batches if b <= upto):
            # the folder first: a mark without a folder is harmless
            delete(spark, batches[b])
            delete(spark, f"{done_root(live_path)}/batch_id={b}")
    return newest if ready else None


def _whole(spark: SparkSession, folder: str) -> bool:
    fs, mark = hadoop_path(spark, f"{folder}/_SUCCESS")
    return fs.exists(mark)
