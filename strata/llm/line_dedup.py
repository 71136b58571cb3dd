"""Line dedup: lines found in many documents stay only in one.

A line's key is the line with ASCII blanks stripped at both ends and A-Z
lower-cased. A key of at least ``min_chars`` code points that at least
``min_docs`` documents hold loses all its lines except in the first document
that holds it, in the order of falling id.

How: each document gives one row for each distinct key, a 128-bit hash with
the positions of its lines. The rows are range-partitioned by hash, document
and position and sorted so within each partition, so a line that a third of
all documents hold spans partitions instead of filling one. Each sorted
partition is streamed: the first row of a run is its first occurrence. Runs
that end inside a batch are decided at once; the rows of the few runs that
touch an end of a batch are decided by a small aggregation. What comes back
is not text but, for each document that loses lines, a compressed bitmap of
the lines to keep.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import int64, map_rows, row_key, text_bytes, written

MIN_CHARS = 40
MIN_DOCS = 5
SALTS = 64
RUN_ROW = "h1 long, h2 long, doc_id long, rk long, n_lines int, positions array<int>"


def line_key(line: bytes) -> bytes:
    return line.strip().lower()  # bytes: ASCII blanks and A-Z only


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each document and distinct long key."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes: list[bytes] = []
        at: list[int] = []
        n_lines: list[int] = []
        positions: list[list[int]] = []
        for i, text in enumerate(batch.column(2).to_pylist()):
            lines = text.split(b"\n")
            found: dict[bytes, list[int]] = {}
            for pos, line in enumerate(lines):
                key = line_key(line)
                if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                    found.setdefault(key, []).append(pos)
            hashes += [xxhash.xxh3_128_digest(k) for k in found]
            positions += found.values()
            at += [i] * len(found)
            n_lines += [len(lines)] * len(found)
        if not at:
            return
        h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
        take = pa.array(at)
        yield pa.RecordBatch.from_arrays(
            [
                int64(h[:, 0]), int64(h[:, 1]), batch.column(0).take(take), batch.column(1).take(take),
                pa.array(n_lines, pa.int32()), pa.array(positions, pa.list_(pa.int32())),
            ],
            ["h1", "h2", "doc_id", "rk", "n_lines", "positions"],
        )

    return map_rows(docs.select("doc_id", "rk", "t"), run, RUN_ROW)


def _streamed(rows: DataFrame, min_docs: int) -> DataFrame:
    """Sorted rows to ``(open, ...)``: rows to drop, and the undecided rows
    (``open``) of runs that touch an end of a batch."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        n = len(h1)
        new = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        of = np.cumsum(new) - 1
        doc = batch.column("doc_id")
        known = doc.is_valid().to_numpy(zero_copy_only=False)
        ids = doc.fill_null(0).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        other = np.concatenate(([True], (ids[1:] != ids[:-1]) | (known[1:] != known[:-1]))) | new
        docs = np.bincount(of, weights=other, minlength=len(starts))
        first = starts[of]  # the run's first occurrence: the largest id
        is_first = (ids == ids[first]) & (known == known[first])
        edge = (of == 0) | (of == of[-1])
        keep = np.flatnonzero(edge | ((docs[of] >= min_docs) & ~is_first))
        out = batch.take(pa.array(keep))
        return pa.RecordBatch.from_arrays([pa.array(edge[keep]), *out.columns], ["open", *out.schema.names]) if n else out

    return map_rows(rows, run, "open boolean, " + RUN_ROW)


def line_drops(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, rk, n_lines, n_dropped, keep)`` of the documents that lose
    lines; ``keep`` is a zlib-compressed little-endian bitmap over the lines."""
    keyed = keyed_lines(docs, min_chars)
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("rk"), F.col("positions")[0]]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = written(_streamed(rows, min_docs), "line-runs")
    pending = found.filter("open")
    who = pending.select("h1", "h2", "doc_id").distinct()  # null ids are one document
    cold = who.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("first")).filter(F.col("n") >= min_docs)
    # A line of a third of all documents is dealt over SALTS tasks here.
    cold = cold.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pending = pending.withColumn("salt", F.pmod(F.xxhash64("doc_id", "rk"), F.lit(SALTS)).cast("int"))
    late = pending.join(cold, ["h1", "h2", "salt"]).filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    cols = ["doc_id", "rk", "n_lines", "positions"]
    drops = found.filter("NOT open").select(*cols).unionByName(late.select(*cols))
    by_doc = drops.groupBy("doc_id", "rk").agg(F.max("n_lines").alias("n_lines"), F.flatten(F.collect_list("positions")).alias("positions"))

    def bitmaps(batch: pa.RecordBatch) -> pa.RecordBatch:
        keeps, gone = [], []
        for n, positions in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            bits = np.ones(n, bool)
            bits[positions] = False
            keeps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            gone.append(n - int(bits.sum()))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(gone, pa.int32()), pa.array(keeps, pa.binary())],
            ["doc_id", "rk", "n_lines", "n_dropped", "keep"],
        )

    return map_rows(by_doc, bitmaps, "doc_id long, rk long, n_lines int, n_dropped int, keep binary")


def kept_lines(text: bytes, keep: bytes | None) -> tuple[bytes, int, int]:
    """The text without the lines that the bitmap drops, its lines before, and those dropped."""
    lines = text.split(b"\n")
    if keep is None:
        return text, len(lines), 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")[: len(lines)]
    stay = [x for x, b in zip(lines, bits.tolist(), strict=True) if b]
    return b"\n".join(stay), len(lines), len(lines) - len(stay)


def _with_bitmaps(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(text_col).alias("rk"), text_bytes(text_col).alias("t"))
    return keyed, line_drops(keyed, min_chars, min_docs)


def dedup_digest(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256, keep)`` for every row.

    A null or empty text is one empty line. Rows that share an id count as one
    document; null ids are one document after all others. Repeated rows lose
    the same lines and all stay. A document may lose all its lines; what is
    left is then empty. Other columns are not read.
    """
    keyed, drops = _with_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    on = keyed["doc_id"].eqNullSafe(drops["doc_id"]) & (keyed["rk"] == drops["rk"])
    rows = keyed.join(drops, on, "left").select(keyed["doc_id"], "t", "keep")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [kept_lines(t, k) for t, k in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()),
                pa.array([hashlib.sha256(x[0]).hexdigest() for x in out]), batch.column(2),
            ],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256", "keep"],
        )

    return map_rows(rows, run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, keep binary")


def dedup_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``docs`` with the dropped lines cut from the text; all its columns and
    rows stay, a text that loses nothing stays as it is (null stays null)."""
    names = docs.columns
    _, drops = _with_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    drops = drops.select(F.col("doc_id").alias("_llm_id"), F.col("rk").alias("_llm_rk"), F.col("keep").alias("_llm_keep"))
    rows = docs.withColumn("_llm_row", row_key(text_col)).join(
        drops, F.col(id_col).cast("long").eqNullSafe(F.col("_llm_id")) & (F.col("_llm_row") == F.col("_llm_rk")), "left"
    )

    @F.arrow_udf(docs.schema[text_col].dataType)
    def kept(texts: pa.Array, keeps: pa.Array) -> pa.Array:
        out = [t if k is None else kept_lines(t.encode(), k)[0].decode() for t, k in zip(texts.to_pylist(), keeps.to_pylist(), strict=True)]
        return pa.array(out, pa.string())

    # Only texts that lose lines go through Python.
    new = F.when(F.col("_llm_keep").isNull(), F.col(text_col)).otherwise(kept(F.when(F.col("_llm_keep").isNotNull(), F.col(text_col)), F.col("_llm_keep")))
    return rows.select(*[new.alias(c) if c == text_col else F.col(c) for c in names])


#: DuckDB SQL for the contract's query.
SQL = f"""
WITH l AS (
  SELECT doc_id, pos, line,
    translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), k AS (
  SELECT key, max(doc_id) AS first FROM l WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE first IS NOT NULL AND first <> doc_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM l LEFT JOIN k USING (key) GROUP BY doc_id
"""
