"""Places and running totals inside ordered groups, however large a group is.

A window function puts a whole group into one task. Here the rows are dealt by
ranges of (group, order), so a group that holds a third of all rows spans
partitions. Each partition is streamed in order and counts from its own start;
what the partitions before it hold of its first group is then added. Only the
first group of a partition can have begun earlier, so that correction is at
most one row for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written


def _differs(column: pa.Array) -> np.ndarray:
    """Whether each value but the first is another than the one before it (null equals null)."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    other = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(other, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _running(values: np.ndarray, start: np.ndarray, carry: int, accumulate) -> np.ndarray:
    """Inclusive totals from each row's ``start`` (-1: goes on from ``carry``).
    ``accumulate`` is ``np.add`` or ``np.bitwise_xor``."""
    with np.errstate(over="ignore"):
        total = accumulate.accumulate(values)
        before = np.concatenate((np.zeros(1, np.int64), total))[np.maximum(start, 0)]
        if accumulate is np.add:
            return total - before + np.where(start < 0, carry, 0)
        return total ^ before ^ np.where(start < 0, carry, 0)


def running(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], sums: Sequence[str] = (), xors: Sequence[str] = (), name: str = "running",
    parts: int | None = None,
) -> DataFrame:
    """``df`` with ``part`` (the range a row was dealt to), ``pos`` (its place in
    its group: 0, 1, ...) and, in their place, the running totals of the long
    columns ``sums`` and ``xors``, the row itself included.

    ``group`` may be empty: then all rows are one group. Groups ascend, null
    first. Null is a group of its own. Rows that tie in ``order`` stand in any
    order: end it with columns that tell apart what must not change places.
    The result reads a written table.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(c).asc_nulls_first() for c in group], *order]
    columns = df.columns

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last: tuple | None = None
        carry: dict[str, int] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for c in group:
                new[1:] |= _differs(batch.column(c))
            new[0] = last != tuple(batch.column(c)[0].as_py() for c in group)
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            cols = dict(zip(columns, batch.columns, strict=True))
            totals = {"pos": _running(np.ones(n, np.int64), start, carry.get("pos", 0), np.add)}
            for c in (*sums, *xors):
                totals[c] = _running(cols[c].to_numpy(), start, carry.get(c, 0), np.add if c in sums else np.bitwise_xor)
            last = tuple(batch.column(c)[n - 1].as_py() for c in group)
            carry = {c: int(x[-1]) for c, x in totals.items()}
            out = {**cols, **{c: pa.array(x) for c, x in totals.items() if c != "pos"}}
            out |= {"part": pa.array(np.full(n, part, np.int32)), "pos": pa.array(totals["pos"] - 1)}
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", part int, pos long"
    dealt = df.repartitionByRange(parts, *keys) if keys else df.repartition(1)
    rows = written(dealt.sortWithinPartitions(*keys).mapInArrow(local, schema), name)
    # The last row of a group in a partition holds the partition's totals of that group.
    at_end = lambda c: F.max_by(c, "pos").alias(c)
    ends = rows.groupBy("part", *group).agg((F.max("pos") + 1).alias("pos"), *[at_end(c) for c in (*sums, *xors)])
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = lambda c: (F.bit_xor(c) if c in xors else F.sum(c)).over(before).alias(f"_{c}")
    late = ends.select(F.col("part").alias("_part"), *[F.col(c).alias(f"_g_{c}") for c in group], *[held(c) for c in ("pos", *sums, *xors)])
    late = late.filter("_pos IS NOT NULL")  # at most one group of each partition
    on = F.col("part") == F.col("_part")
    for c in group:
        on &= F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    fixed = {c: F.coalesce(F.col(c) + F.col(f"_{c}"), F.col(c)) for c in ("pos", *sums)}
    fixed |= {c: F.coalesce(F.col(c).bitwiseXOR(F.col(f"_{c}")), F.col(c)) for c in xors}
    return rows.join(F.broadcast(late), on, "left").select(*[fixed[c].alias(c) if c in fixed else F.col(c) for c in rows.columns])
