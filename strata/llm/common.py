"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: A word is a maximal run without these bytes; ``bytes.split()`` uses the same set.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read
    back: the plan is cut, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch; it gives one batch or several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from (out,) if isinstance(out, pa.RecordBatch) else out

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes in a binary column,
    one row at least, so that what a task holds follows bytes and not rows."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(run)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes (null as empty), so that tasks need not decode it."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def row_key(*columns: str) -> Column:
    """Tells rows that share an id but hold different values apart."""
    return F.xxhash64(*[F.col(c) for c in columns])


def int64(values) -> pa.Array:
    """uint64 or int64 numpy values as a Spark long."""
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indices over the links
    ``a[i] - b[i]`` (hooking and pointer jumping)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; nodes have the same
    ``component``, one of them, if and only if they are connected.

    Contraction: each round every node picks, among itself and its neighbours,
    the first in a hashed order that changes with the round; edges are then
    drawn between the picks, and those inside one pick vanish. Stars are gone
    after one round, long chains lose a constant share in each. A round is one
    partial aggregation and two joins over the edges that are left; picks and
    edges go to written tables. Only whether edges are left reaches the driver.
    """
    a, b = F.col(src), F.col(dst)
    e = written(edges.filter(a != b).select(a.alias("u"), b.alias("v")), "edges")
    picks: list[DataFrame] = []
    while not e.isEmpty():
        if len(picks) == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        order = lambda c, r=len(picks): F.struct(F.xxhash64(F.col(c), F.lit(r)).alias("h"), F.col(c).alias("x"))
        first = both.groupBy("u").agg(F.min(order("v")).alias("f")).select("u", F.least(F.col("f"), order("u")).alias("f"))
        p = written(first.select("u", F.col("f.x").alias("p")), "picks")
        picks.append(p)
        ends = e.join(p, "u").select("v", F.col("p").alias("a")).join(p.select(F.col("u").alias("v"), F.col("p").alias("b")), "v")
        e = written(ends.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if not picks:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = picks[0].select(F.col("u").alias("node"), F.col("p").alias("component"))
    for p in picks[1:]:
        later = p.select(F.col("u").alias("component"), F.col("p").alias("_p"))
        out = out.join(later, "component", "left").select("node", F.coalesce("_p", "component").alias("component"))
    return out


def n_chars_after(changed: DataFrame, docs: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """``changed`` with ``n_chars`` counted anew, if there is such a column."""
    if n_chars_col not in docs.columns:
        return changed
    return changed.withColumn(n_chars_col, F.length(text_col).cast(docs.schema[n_chars_col].dataType))
