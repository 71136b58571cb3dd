"""Conflict-constrained best-fit packing.

Documents are packed into bins of ``capacity`` words. Two rules bind a bin: it
holds at most one piece of each source and one of each duplicate cluster. A
document longer than a bin is cut: its full pieces are bins of their own, its
rest is packed like any other document.

Bins are kept in the order of what is left in them. A piece looks up the
first bin with room (the tightest) and goes on to its successors until one
has neither its source nor its cluster, tested on two bitmaps that each bin
carries; if none has, it opens a bin. Pieces come in falling size.

Spark deals the rests to shards of about ``SHARD`` pieces by a hash of the
document and, for equal rows, of their number, so that a source or cluster that
holds a third of all rows is spread over all shards and the bins do not depend
on the order of the rows. Each shard is packed in one task with memory for its
own pieces only. Bins that stay below ``FILLED`` of their capacity are opened
again: their pieces are dealt to fewer shards and packed once more, which lets
pieces meet that a round before kept apart; at most ``ROUNDS`` rounds, and none
that would open nearly all bins of the last.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows, row_key, text_bytes, written
from strata.llm.ordered import running

CAPACITY = 2048
SHARD = 4096
FILLED = 0.95
ROUNDS = 5


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of each piece; pieces must come in falling size. Sources and
    clusters are small numbers, used as bit positions."""
    left: list[tuple[int, int]] = []  # (words left, bin), in order
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    out = []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        s_bit, c_bit = 1 << s, (1 << c if c >= 0 else 0)
        for at in range(bisect_left(left, (size, -1)), len(left)):
            b = left[at][1]
            if not (source_bits[b] & s_bit or cluster_bits[b] & c_bit):
                room = left.pop(at)[0] - size
                break
        else:
            b, room = len(source_bits), capacity - size
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[b] |= s_bit
        cluster_bits[b] |= c_bit
        if room > 0:
            insort(left, (room, b))
        out.append(b)
    return out


def copies_key(text_col: str = "text") -> Column:
    """The default cluster: texts that are equal but for case and blanks; null for texts without words."""
    text = F.lower(F.trim(F.regexp_replace(F.col(text_col), r"[\x20\x09-\x0D]+", " ")))
    return F.when(text != "", F.xxhash64(text))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, cluster: Column | None) -> DataFrame:
    """(doc_id, rk, source, cluster, n_words); the words are counted on bytes."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_key(text_col).alias("rk"), F.xxhash64(F.col(source_col)).alias("source"),
        (copies_key(text_col) if cluster is None else F.when(cluster.isNotNull(), F.xxhash64(cluster))).alias("cluster"), text_bytes(text_col).alias("t"),
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [len(t.split()) for t in batch.column(4).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(n, pa.int64())], ["doc_id", "rk", "source", "cluster", "n_words"])

    return map_rows(rows, run, "doc_id long, rk long, source long, cluster long, n_words long")


def pack(
    docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", cluster: Column | None = None,
) -> DataFrame:
    """``(doc_id, n_words, piece, start_word, size, bin_id, source_hash, cluster)``,
    one row for each piece.

    A null or empty text is a piece of size 0: it takes no room but obeys both
    rules. A null source is a source, a null id is kept. Repeated rows are
    copies: they share a cluster and so never share a bin. ``cluster`` names
    the duplicate clusters; left out, texts equal but for case and blanks
    form one. Null clusters conflict with nothing. ``bin_id`` is unique over
    all shards. The bins are the same whatever the order of the rows; which of
    equal rows goes where is arbitrary. Other columns are not read.
    """
    rows = written(sized(docs, id_col, text_col, source_col, cluster), "pack-sizes")
    n_rows = rows.count()
    same = ["doc_id", "rk", "source", "cluster"]
    pieces = running(rows, same, [F.col("n_words")], name="pack-copies").withColumnRenamed("pos", "copy").drop("part")  # equal rows are numbered
    rest = F.when((F.col("n_words") % capacity == 0) & (F.col("n_words") > 0), F.lit(capacity)).otherwise(F.col("n_words") % capacity)
    pieces = pieces.withColumn("last", rest).withColumn("full", ((F.col("n_words") - F.col("last")) / capacity).cast("long"))

    def dealt(some: DataFrame, count: int, salt: str) -> tuple[DataFrame, int]:
        """Pieces in shards, each in falling size."""
        shards = max(1, -(-count // shard))
        spot = F.pmod(F.xxhash64(*same, "copy", F.lit(salt)), F.lit(shards))
        order = [F.col("shard"), F.col("last").desc(), *same, "copy"]
        return some.select(*same, "copy", "n_words", "full", "last", spot.alias("shard")).repartition("shard").sortWithinPartitions(*order), shards

    schema = "doc_id long, n_words long, piece long, start_word long, size long, bin_id string, source_hash long, cluster long"
    names = ["doc_id", "n_words", "piece", "start_word", "size", "bin_id", "source_hash", "cluster"]

    def packed(t: pa.Table, name: str) -> pa.RecordBatch:
        """One shard, in falling size; ``fill`` is that of the piece's bin."""
        source = np.unique(t.column("source").to_numpy(), return_inverse=True)[1]
        clusters = t.column("cluster").combine_chunks()
        ids, at, n = np.unique(clusters.fill_null(0).to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
        bit = np.where(n > 1, np.cumsum(n > 1) - 1, -1)[at]  # a cluster of one piece conflicts with nothing
        bit = np.where(clusters.is_valid().to_numpy(zero_copy_only=False), bit, -1)
        sizes = t.column("last").to_pylist()
        bins = best_fit(sizes, source.tolist(), bit.tolist(), capacity)
        number = t.column("shard")[0].as_py()
        full = t.column("full").to_numpy()
        fill = np.bincount(bins, sizes)[bins] / capacity
        return pa.RecordBatch.from_arrays(
            [
                t.column("doc_id").combine_chunks(), t.column("n_words").combine_chunks(), pa.array(full), pa.array(full * capacity),
                pa.array(sizes, pa.int64()), pa.array([f"{name}{number}-{b}" for b in bins]), t.column("source").combine_chunks(), clusters,
                t.column("rk").combine_chunks(), t.column("copy").combine_chunks(), pa.array(fill),
            ],
            [*names, "rk", "copy", "fill"],
        )

    def packer(name: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                if not batch.num_rows:
                    continue
                number = batch.column("shard").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    part = batch.slice(a, b - a)
                    if held and held[0].column("shard")[0].as_py() != part.column("shard")[0].as_py():
                        yield packed(pa.Table.from_batches(held), name)
                        held = []
                    held.append(part)
            if held:
                yield packed(pa.Table.from_batches(held), name)

        return run

    inner = schema + ", rk long, copy long, fill double"
    closed: list[DataFrame] = []
    loose, count = pieces, n_rows
    for number in range(ROUNDS):
        rests, shards = dealt(loose, count, f"round {number}")
        bins = rests.mapInArrow(packer(f"{number}-"), inner)
        if shards == 1 or number == ROUNDS - 1:
            break
        bins = written(bins, "pack-round")
        again = bins.filter(F.col("fill") < FILLED)
        before, count = count, again.count()
        if count > 0.9 * before:  # what is left conflicts, or is small in all
            break
        closed.append(bins.filter(F.col("fill") >= FILLED))
        loose = again.withColumnsRenamed({"source_hash": "source", "piece": "full", "size": "last"})
    for done in closed:
        bins = bins.unionByName(done)
    whole = pieces.filter("full > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)))
    whole = whole.select(
        "doc_id", "n_words", "piece", (F.col("piece") * capacity).alias("start_word"), F.lit(capacity).cast("long").alias("size"),
        F.concat_ws("-", F.lit("full"), F.hex(F.xxhash64(*same)), F.hex("rk"), "copy", "piece").alias("bin_id"),
        F.col("source").alias("source_hash"), "cluster",
    )
    return bins.select(*names).unionByName(whole)
