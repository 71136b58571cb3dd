"""Epochs of the final Gold table.

A file-sink table has a log that lists every file it ever got, and a stateful
query keeps the number of state partitions that its first checkpoint recorded.
Both end with an epoch: a folder, a sink log and a checkpoint of their own, for
the hours from ``start`` on (:func:`strata.streaming.epochs.roll_gold` begins
one). Epoch 0 is the table's own folder; the others stand beside it:

    <gold>_epochs/<n>/             rows of epoch n
    <gold>_epochs/_list/<n>=<s>    epoch n begins at the hour of s (unix seconds)

The hours of an epoch end where the next one begins, so a read of some dates
opens the logs of the epochs that hold them and no others.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import SparkSession

from strata.storage import hadoop_path


@dataclass(frozen=True)
class Epoch:
    number: int
    folder: str
    start: int | None  # unix seconds; None: from the beginning
    end: int | None = None  # where the next one begins; None: the last

    def overlaps(self, start_date: str | None, end_date: str | None) -> bool:
        seconds = lambda day: dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc).timestamp()
        after = start_date is not None and self.end is not None and seconds(start_date) >= self.end
        before = end_date is not None and self.start is not None and seconds(end_date) + 86400 <= self.start
        return not (after or before)


def epochs_root(gold: str) -> str:
    return gold.rstrip("/") + "_epochs"


def gold_epochs(spark: SparkSession, gold: str) -> list[Epoch]:
    """The epochs of a Gold table, oldest first (a listing, no job)."""
    fs, root = hadoop_path(spark, f"{epochs_root(gold)}/_list")
    starts = {}
    if fs.exists(root):
        for status in fs.listStatus(root):
            number, _, start = status.getPath().getName().partition("=")
            if number.isdigit():
                starts[int(number)] = int(start)
    found = [(0, gold, None), *[(n, f"{epochs_root(gold)}/{n}", s) for n, s in sorted(starts.items())]]
    ends = [*[s for _, _, s in found[1:]], None]
    return [Epoch(n, folder, start, end) for (n, folder, start), end in zip(found, ends, strict=True)]
