"""Substring dedup: passages of ``length`` words or more that occur twice.

Every word covered by a window of ``length`` consecutive words that also
starts anywhere else (in any document, the same one included) is removed.
The union of those windows is the union of the maximal repeats of at least
that length.

Seed: each window's anchor is its ``K``-word gram of smallest hash (winnowing:
equal windows have equal anchors, so no repeat is missed). Anchors that occur
once in the corpus are out.
Windows instead of extension: the whole windows around each repeated anchor
are grouped by a 95-bit hash. Documents are not joined on anchors and no match
is extended; adjacent repeated windows make up the words of a maximal repeat,
however far it reaches on both sides, but which repeat they belong to is not
kept.

Seeds and windows both need "which of these keys occurs again?". A map task
answers it for the keys that it sees twice, and sends on one delegate for each
of them, so a passage that a third of all documents share gives a row for each
task and not for each copy. Only keys that a batch holds once wait for the
shuffle. Pairs of copies are never formed.

Rows are told apart by 128 bits of id and text: rows that agree in both are
copies of each other and lose the same words.

Texts cross a shuffle compressed, once to meet their seeds; those that have
seeds, usually the smaller part, once more to meet their repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import int64, map_rows, slices, text_bytes, written

LENGTH = 35
#: Words of an anchor. A window of 35 words has 24 of them.
K = 12
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
ALONE, DELEGATE, KNOWN = 0, 1, 2
#: Keys of which a task remembers that it has sent a delegate.
MOST_SENT = 2_000_000
#: Bytes of text that a task looks at together.
SLICE = 12 << 20


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """(2, n): two independent 64-bit hashes of each word."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), np.uint64).reshape(-1, 2).T


def gram_hashes(h: np.ndarray, n: int, lane: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words: a polynomial put together from runs of
    1, 2, 4, ... words."""
    count = len(h) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out: np.ndarray | None = None
    done, size, power, run = 0, 1, _M[lane], h
    out_power = np.uint64(1)
    with np.errstate(over="ignore"):
        while True:
            if n & size:
                part = run[done : done + count]
                out = part.copy() if out is None else out + out_power * part
                out_power, done = out_power * power, done + size
            if done == n:
                return _mixed(out)
            run = run[:-size] + power * run[size:]
            power, size = power * power, size * 2


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` grams, the position of its smallest, the
    first of equals."""
    value, at = grams, np.arange(len(grams))
    size = 1
    while size < span:
        step = min(size, span - size)
        later = value[step:] < value[:-step]
        value, at = np.where(later, value[step:], value[:-step]), np.where(later, at[step:], at[:-step])
        size += step
    return at


def _states(*keys: np.ndarray) -> np.ndarray:
    """ALONE for keys found once; of the others, one DELEGATE each, the rest KNOWN."""
    order = np.lexsort(keys)
    same = np.all([k[order][1:] == k[order][:-1] for k in keys], axis=0)
    before, after = np.concatenate(([False], same)), np.concatenate((same, [False]))
    state = np.empty(len(order), np.int8)
    state[order] = np.where(before, KNOWN, np.where(after, DELEGATE, ALONE))
    return state


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows found to repeat in their batch, and those alone in it whose
    key another batch holds. ``known`` rows carry keys of their own that
    spread them evenly; they only pass through."""
    again = F.count(F.lit(1)).over(Window.partitionBy(*keys, "known")) > 1
    return rows.withColumn("again", again).filter((F.col("state") != ALONE) | F.col("again"))


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, i, r, t)``: i and r, 64 bits each with seeds of their own, tell
    rows of another id or text apart (a null id is another than 0)."""
    i, null = F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")), F.col(id_col).isNull()
    first, second = (F.xxhash64(F.lit(seed), i, null, F.col(text_col)) for seed in (1, 2))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), first.alias("i"), second.alias("r"), text_bytes(text_col).alias("t"))


class Sent:
    """Keys whose delegate a task has sent: their later copies are known to repeat."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] | None = None

    def states(self, *keys: np.ndarray) -> np.ndarray:
        """As :func:`_states`, over all that the task has seen."""
        state = _states(*keys)
        if self.keys is not None and len(keys[0]):
            # Of keys that agree in their first half only one is found; the others are sent again.
            at = np.minimum(np.searchsorted(self.keys[0], keys[0]), len(self.keys[0]) - 1)
            state[np.all([s[at] == k for s, k in zip(self.keys, keys, strict=True)], axis=0)] = KNOWN
        new = [k[state == DELEGATE] for k in keys]  # none of them sent before
        order = np.argsort(new[0])
        if self.keys is None:
            self.keys = [k[order] for k in new] if len(order) else None
        elif len(self.keys[0]) < MOST_SENT:
            at = np.searchsorted(self.keys[0], new[0][order])
            self.keys = [np.insert(s, at, k[order]) for s, k in zip(self.keys, new, strict=True)]
        return state


def seeds(docs: DataFrame, length: int, k: int) -> DataFrame:
    """``(i, seeds)``: the places of each document's anchors that occur again.
    Should two rows share an ``i``, both get the seeds of either: a seed is only
    a place to look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent()
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                yield from of(part, sent)

    def of(batch: pa.RecordBatch, sent: Sent) -> Iterator[pa.RecordBatch]:
        refs, keys, places = [], [], []
        for ref, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = text.split()
            if len(words) < length:
                continue
            grams = gram_hashes(word_hashes(words)[0], k, 0)
            at = np.unique(anchors(grams, length - k + 1))
            refs.append(np.full(len(at), ref, np.int64))
            keys.append(grams[at])
            places.append(at)
        if refs:
            key, ref, place = np.concatenate(keys), np.concatenate(refs), np.concatenate(places)
            state = sent.states(key)
            known = state == KNOWN
            key = np.where(known, _spread(ref, place), key)
            yield pa.RecordBatch.from_arrays(
                [int64(key), pa.array(known), pa.array(ref), pa.array(place.astype(np.int32)), pa.array(state)],
                ["key", "known", "i", "place", "state"],
            )

    found = _repeated(docs.select("i", "t").mapInArrow(run, "key long, known boolean, i long, place int, state tinyint"), "key")
    return found.groupBy("i").agg(F.collect_list("place").alias("seeds"))


def _spread(ref: np.ndarray, place: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(ref.view(np.uint64) + place.astype(np.uint64) * _M[1])


def with_seeds(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """``(i, r, z, seeds)`` of the documents that have seeds, written once:
    windows and removal both read it. ``docs`` as by :func:`identified`."""
    packed = docs.select("i", "r", _compressed(F.col("t")).alias("z"))
    return written(packed.join(seeds(docs, length, k), "i").select("i", "r", "z", "seeds"), "seeded")


def repeated_windows(seeded: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """``(i, r, runs)``: where each document's repeated windows start, as runs
    ``(start, n)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent()
        for batch in batches:
            for part in slices(batch, 2, SLICE // 3):  # compressed
                yield from windows(part, sent)

    def windows(batch: pa.RecordBatch, seen: Sent) -> Iterator[pa.RecordBatch]:
        of, starts, w1, w2 = [], [], [], []
        for x, (z, places) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            h = word_hashes(_plain(z).split())
            marked = np.zeros(max(h.shape[1], max(places) + 1), bool)
            marked[places] = True
            at = np.flatnonzero(marked[anchors(gram_hashes(h[0], k, 0), length - k + 1)])
            of.append(np.full(len(at), x))
            starts.append(at)
            w1.append(gram_hashes(h[0], length, 0)[at])
            w2.append(gram_hashes(h[1], length, 1)[at] >> np.uint64(33))  # 95 bits tell windows apart
        of, start, w1, w2 = (np.concatenate(x) for x in (of, starts, w1, w2))
        if not len(of):
            return
        state = seen.states(w1, w2)
        sent = np.flatnonzero(state != KNOWN)
        yield _window_rows(batch, of[sent], start[sent], np.ones(len(sent), np.int64), w1[sent], w2[sent], state[sent])
        rest = np.flatnonzero(state == KNOWN)
        if len(rest):
            first = np.concatenate(([True], (of[rest][1:] != of[rest][:-1]) | (start[rest][1:] != start[rest][:-1] + 1)))
            at = rest[first]
            n = np.diff(np.concatenate((np.flatnonzero(first), [len(rest)])))
            yield _window_rows(batch, of[at], start[at], n, w1[at], w2[at], state[at])

    schema = "i long, r long, start int, n int, w1 long, w2 int, state tinyint, known boolean"
    found = _repeated(seeded.mapInArrow(run, schema), "w1", "w2")
    return found.groupBy("i", "r").agg(F.collect_list(F.struct("start", "n")).alias("runs"))


def _window_rows(batch, of, start, n, w1, w2, state) -> pa.RecordBatch:
    take = pa.array(of)
    known = state == KNOWN
    own = batch.column(0).take(take).to_numpy(zero_copy_only=False)
    w1 = np.where(known, _spread(own, start), w1)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(own), batch.column(1).take(take), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
            int64(w1), pa.array(w2.astype(np.int32)), pa.array(state.astype(np.int8)), pa.array(known),
        ],
        ["i", "r", "start", "n", "w1", "w2", "state", "known"],
    )


def _compressed(column: Column) -> Column:
    """Texts cross the shuffle compressed: the row format's own is weaker."""

    @F.arrow_udf("binary")
    def compressed(texts: pa.Array) -> pa.Array:
        z = zstandard.ZstdCompressor(level=9)
        return pa.array([z.compress(t) for t in texts.to_pylist()], pa.binary())

    return compressed(column)


def _plain(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


def covered(n_words: int, runs: list[dict] | None, length: int) -> np.ndarray:
    """Mask of the words that the windows in ``runs`` cover."""
    edge = np.zeros(n_words + 1, np.int64)
    for r in runs or ():
        edge[r["start"]] += 1
        edge[r["start"] + r["n"] - 1 + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _removed(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(words, mask of those removed, kept text) of rows that end in z, runs."""
    for z, runs in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
        words = _plain(z).split()
        gone = covered(len(words), runs, length)
        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words
        yield len(words), gone, b" ".join(kept)


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, spans)`` for every row: the kept
    words joined by one space, and the removed spans ``(first word, words)``.

    Null and empty texts have no words. Texts shorter than ``length`` words
    keep all. Repeated rows are copies of each other: each loses its windows.
    Null ids are kept. Other columns are not read.
    """
    rows = identified(docs, id_col, text_col)
    runs = repeated_windows(with_seeds(rows, length, k), length, k)
    joined = rows.select("doc_id", "i", "r", _compressed(F.col("t")).alias("z")).join(runs, ["i", "r"], "left").select("doc_id", "z", "runs")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, kept, spans = [], [], [], []
        for n, gone, text in _removed(batch, length):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).tolist()
            n_words.append(n)
            n_removed.append(int(gone.sum()))
            kept.append(text)
            spans.append([{"first": a, "words": b - a} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)],
            ["doc_id", "n_words", "n_removed", "kept", "spans"],
        )

    schema = "doc_id long, n_words long, n_removed long, kept binary, spans array<struct<first: int, words: int>>"
    return map_rows(joined, run, schema).withColumn("kept", F.col("kept").cast("string"))


def removal_digest(docs: DataFrame, length: int = LENGTH, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` for every row: as
    :func:`remove_repeats`, with the SHA-256 of the kept text instead of it.
    Texts that lose nothing are digested where they are read and do not move."""
    rows = identified(docs, id_col, text_col)
    seeded = with_seeds(rows, length, k)
    cut = seeded.select("i", "r", "z").join(repeated_windows(seeded, length, k), ["i", "r"])

    def removed(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [(int(gone.sum()), hashlib.sha256(text).hexdigest()) for _, gone, text in _removed(batch, length)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out])], ["i", "r", "n_removed", "cut_sha256"]
        )

    @F.arrow_udf("struct<n_words: long, sha256: string>")
    def whole(texts: pa.Array) -> pa.Array:
        words = [t.split() for t in texts.to_pylist()]
        sums = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
        return pa.StructArray.from_arrays([pa.array([len(w) for w in words], pa.int64()), pa.array(sums, pa.string())], names=["n_words", "sha256"])

    # Rows equal in id and text lose the same words: one of them speaks for all.
    cut = map_rows(cut, removed, "i long, r long, n_removed long, cut_sha256 string").dropDuplicates(["i", "r"])
    all_ = rows.select("doc_id", "i", "r", whole("t").alias("w")).join(cut, ["i", "r"], "left")
    return all_.select(
        "doc_id", "w.n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("cut_sha256", "w.sha256").alias("kept_sha256")
    )


#: DuckDB SQL for the contract's query.
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), w AS (
  SELECT r, i, md5(array_to_string(words[i:i + {LENGTH - 1}], ' ')) AS m FROM (SELECT *, unnest(range(1, len(words) - {LENGTH - 2})) AS i FROM d)
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + {LENGTH})) AS at FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)
), k AS (
  SELECT d.r, string_agg(word, ' ' ORDER BY d.at) AS kept, count(*) AS n FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS at FROM d) d
  LEFT JOIN gone ON gone.r = d.r AND gone.at = d.at WHERE gone.r IS NULL GROUP BY d.r
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
