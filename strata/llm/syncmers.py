"""Document fingerprints of closed syncmers.

A ``K``-mer of bytes is a closed syncmer if the smallest of its ``S``-mers (by
hash) is its first or its last. Whether it is one depends on its own bytes
alone, so the same passage has the same anchors in any document, wherever it
stands. ``anchors`` gives their places for positional matching; the
fingerprint keeps the smallest anchor hash of each of ``BINS`` bins, 16 bits
each, so the share of equal bins estimates how much two texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 24
S = 8  # bytes, so that an S-mer is one 64-bit number
BINS = 64
#: Ranges of ids for each partition: several small ones even out what a partition gets.
RANGES = 8


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places (bytes) and hashes of the closed syncmers. A text shorter than
    ``K`` bytes is its own only anchor; an empty one has none."""
    if len(text) < K:
        whole = [xxhash.xxh3_64_intdigest(text)] if text else []
        return np.zeros(len(whole), np.int64), np.array(whole, np.uint64)
    x = np.frombuffer(text, np.uint8).astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    s = _mixed(x)
    span = K - S + 1
    low = s
    for step in (1, 2, 4, 8):  # smallest of 16
        low = np.minimum(low[:-step], low[step:])
    low = np.minimum(low[: len(s) - span + 1], s[span - 1 :])
    at = np.flatnonzero((s[: len(low)] == low) | (s[span - 1 :] == low))
    with np.errstate(over="ignore"):
        h = _mixed(x[at] + np.uint64(0x9E3779B97F4A7C15) * _mixed(x[at + 8] + np.uint64(0x9E3779B97F4A7C15) * _mixed(x[at + 16])))
    return at, h


def fingerprint(text: bytes) -> np.ndarray:
    """(BINS,) 16-bit values; 0 is an empty bin."""
    h = np.sort(anchors(text)[1])
    out = np.zeros(BINS, np.uint16)
    bins = (h >> np.uint64(58)).astype(np.int64)
    if len(h):
        first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
        out[bins[first]] = np.maximum((h[first] & np.uint64(0xFFFF)).astype(np.uint16), 1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the bins filled in either that are equal in both; two empty
    fingerprints are alike (1)."""
    filled = (a > 0) | (b > 0)
    return float((a == b)[filled].mean()) if filled.any() else 1.0


def fingerprint_hex(f: np.ndarray) -> str:
    return f.astype(">u2").tobytes().hex()


def document_anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, anchors)``: place and hash of every anchor of every text, for
    positional matching. Null texts have none."""

    @F.arrow_udf("array<struct<place: int, hash: long>>")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            at, h = anchors(t or b"")
            out.append([{"place": p, "hash": v} for p, v in zip(at.tolist(), h.view(np.int64).tolist(), strict=True)])
        return pa.array(out, pa.list_(pa.struct([("place", pa.int32()), ("hash", pa.int64())])))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), of(F.col(text_col).cast("binary")).alias("anchors"))


def with_successor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """``(bucket, halo, doc_id, t)`` dealt and sorted so that each row is
    followed by the next document in the order of falling id (null last), equal
    ids by the hash of their text.

    The ids are cut into ranges at their quantiles. An id that holds more than
    two ranges' worth of rows, or the rows without one, is cut further by the
    hash of the text; only copies equal in id and text stay together. The first
    document of each range is sent to the range before it as well (``halo``),
    and the very first to the last range. Only the ids, and the texts of such
    heavy ids, are read for that; the driver holds a few numbers for each range.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    ids = rows.select("doc_id")
    ranges = parts * RANGES
    shares = [i / ranges for i in range(ranges)]  # the first, the least id, is no cut
    found = np.array(ids.filter("doc_id IS NOT NULL").approxQuantile("doc_id", shares, 0.25 / ranges), np.float64)
    heavy = found[1:][found[1:] == found[:-1]]  # an id of several ranges gets one of its own
    cuts = np.unique(np.concatenate((found[1:], heavy, heavy + 1)))

    def bucket(values: pa.Array) -> np.ndarray:
        known = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
        return np.where(values.is_valid().to_numpy(zero_copy_only=False), np.searchsorted(cuts, known, side="right") + 1, 0)

    @F.arrow_udf("int")
    def bucket_of(x: pa.Array) -> pa.Array:
        return pa.array(bucket(x).astype(np.int32))

    seen = ids.groupBy(bucket_of("doc_id").alias("b")).agg(F.max("doc_id").alias("head"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).collect()
    mean = sum(r["n"] for r in seen) / ranges
    # Slices of the hash, for buckets of a single id.
    slices = {r["b"]: int(-(-r["n"] // max(1, mean))) if r["head"] == r["least"] and r["n"] > 2 * mean else 1 for r in seen}
    cut_by_hash = sorted(b for b, k in slices.items() if k > 1)

    def slice_of(h: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = np.ones(max([1, *[x + 1 for x in slices]]), np.uint64)
        k[list(slices)] = list(slices.values())
        high = (h.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)  # rises with the signed hash
        return ((high * k[b]) >> np.uint64(32)).astype(np.int64)

    @F.arrow_udf("struct<b: int, s: int>")
    def places_of(x: pa.Array, h: pa.Array) -> pa.Array:
        b = bucket(x)
        return pa.StructArray.from_arrays([pa.array(b.astype(np.int32)), pa.array(slice_of(h.to_numpy(), b).astype(np.int32))], names=["b", "s"])

    hashed = rows.withColumn("h", F.xxhash64("t"))
    heads: dict[tuple[int, int], int | None] = {(r["b"], 0): r["head"] for r in seen if slices[r["b"]] == 1}  # the id of the first document
    if cut_by_hash:
        some = hashed.filter(bucket_of("doc_id").isin(cut_by_hash)).select(places_of("doc_id", "h").alias("p"), "h")
        heads |= {(r["b"], r["s"]): r["h"] for r in some.groupBy("p.b", "p.s").agg(F.min("h").alias("h")).collect()}  # its hash
    order = sorted(heads, key=lambda x: (-x[0], x[1]))  # as the documents follow each other
    number = {x: i for i, x in enumerate(order)}

    @F.arrow_udf("array<struct<bucket: int, halo: boolean>>")
    def places(x: pa.Array, h: pa.Array) -> pa.Array:
        b = bucket(x)
        s = slice_of(h.to_numpy(), b)
        out = []
        for v, w, own in zip(x.to_pylist(), h.to_pylist(), zip(b.tolist(), s.tolist(), strict=True), strict=True):
            i = number[own]
            first = heads[own] == (w if slices[own[0]] > 1 else v)
            out.append([{"bucket": i, "halo": False}] + ([{"bucket": (i - 1) % len(order), "halo": True}] if first else []))
        return pa.array(out, pa.list_(pa.struct([("bucket", pa.int32()), ("halo", pa.bool_())])))

    dealt = hashed.withColumn("p", F.explode(places("doc_id", "h"))).select("p.bucket", "p.halo", "doc_id", "h", "t")
    return dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "halo", F.col("doc_id").desc_nulls_last(), "h", "t").drop("h")


def edited_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)`` for every row. The edited text ends with the
    beginning of the next document instead of its own last third. A null text
    is empty. Rows that share an id follow each other in the order of their
    text's hash; null ids come last. A single row is followed by itself.
    Other columns are not read.
    """
    rows = with_successor(docs, id_col, text_col, parts)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def result(doc_id: int | None, text: str, own: np.ndarray, following: str, next_own: np.ndarray) -> tuple:
        m = len(text) // 3
        edited = (text[: len(text) - m] + following[:m]).encode()
        other = fingerprint(edited)
        return (
            doc_id, len(text), hashlib.sha256(edited).hexdigest(), fingerprint_hex(own), fingerprint_hex(other), likeness(own, other),
            likeness(own, next_own),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # (bucket, doc_id, text, fingerprint)
        for batch in batches:
            out = []
            columns = [batch.column(c) for c in ("bucket", "halo", "doc_id", "t")]
            for i in range(batch.num_rows):
                b, halo, doc_id, text = (c[i].as_py() for c in columns)
                if halo and (held is None or held[0] != b):
                    continue  # further rows with the head's id
                own = fingerprint(text.encode())
                if held is not None and held[0] == b:
                    out.append(result(*held[1:], text, own))
                held = None if halo else (b, doc_id, text, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return rows.mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
