"""Beginning a new epoch of final Gold: a short sink log, and state under
another number of partitions.

The state of the Gold query holds the hours that the watermark has not closed.
Their rows are all in Silver, so it need not be moved: the new epoch's query
starts with an empty state and reads Silver from the end of the newest closed
hour on, which is a filter on Silver's date partition. What it emits is what
the old query would have, however many state partitions either has.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from strata.sources.epochs import epochs_root, gold_epochs
from strata.sources.tables import newest_closed, read_gold
from strata.storage import hadoop_path
from strata.streaming.layers import LayerPaths, gold_checkpoint


def roll_gold(spark: SparkSession, paths: LayerPaths) -> int | None:
    """Begin a new epoch of final Gold; returns its number. None, and nothing
    is done, while no hour has been closed in the present one. Stop the Gold
    query first and start it again afterwards, with the ``state_partitions``
    wanted. Rows of hours before the new epoch's are late rows as ever: Silver
    has them, a repair brings them to Gold."""
    last = gold_epochs(spark, paths.gold)[-1]
    # Stateful queries run in sessions of their own; the application knows all of them.
    running = spark._jsparkSession.sharedState().activeStreamingQueries().values()
    used = hadoop_path(spark, gold_checkpoint(paths, last.number))[1].toUri().getPath()
    if any(q.resolvedCheckpointRoot().rstrip("/").endswith(used) for q in running):
        raise RuntimeError("stop the Gold query before its table begins a new epoch")
    newest = newest_closed(read_gold(spark, paths.gold))
    if newest is None:
        return None
    day, hour = newest
    start = int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp()) + 3600 * (hour + 1)
    if last.start is not None and start <= last.start:
        return None
    number = last.number + 1
    fs, mark = hadoop_path(spark, f"{epochs_root(paths.gold)}/_list/{number}={start}")
    fs.mkdirs(hadoop_path(spark, f"{epochs_root(paths.gold)}/{number}")[1])
    fs.create(mark, False).close()  # in force from here on
    return number
