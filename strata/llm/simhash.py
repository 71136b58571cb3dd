"""SimHash near-duplicates, compared bit-sliced.

Fingerprints are 64-bit SimHashes of word shingles. Two fingerprints link at
``radius`` or fewer differing bits. Distinct fingerprints only are compared:
copies share a fingerprint and so a class.

Candidates: the 64 bits are cut into ``radius + 2`` blocks; two linked
fingerprints agree on at least two whole blocks, so each fingerprint goes to
one bucket per pair of blocks (6 for radius 2, keys of 32 bits). No link is
lost. A bucket of more than ``BLOCK`` fingerprints is cut into blocks that
are compared pair by pair, so no task gets an unbounded group.

Comparison: the fingerprints of many buckets are stored as 64 vertical bit
planes. XOR of two planes gives one bit of difference for 64 pairs at a time;
carry-save counters add those bits up and saturate above the radius. A block
of pairs is abandoned once all its pairs are above the radius.

Links leave a task as a spanning forest of each bucket, never as all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import connected_components, int64, local_roots, row_key, text_bytes, written

SEED = 42
#: Fingerprints of a bucket compared in one task at most (two blocks of this size).
BLOCK = 8192
#: Buckets up to this size are compared together, many at a time.
SMALL = 64
#: Pairs of words (64 pairs each) in a block that is abandoned as a whole.
WORDS = 64
#: Planes between two looks at which blocks can be abandoned.
STEP = 8


def simhash(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash; no words: 0."""
    words = text.lower().split()  # bytes.lower changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return _majority(np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    return _majority(np.array(hashes, np.uint64))


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):  # bounded for very long texts
        bits = np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``(doc_id, fp)`` and the columns to carry, for every row; ``fp`` is the
    fingerprint as a signed long."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return int64(np.array([simhash(t, shingle) for t in texts.to_pylist()], np.uint64))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), of(text_bytes(text_col)).alias("fp"), *(carry or []))


# ------------------------------------------------------------ bit-sliced comparison


def bit_rows(values: np.ndarray) -> np.ndarray:
    """(64, n) bytes: the bits of ``n`` unsigned 64-bit values, one plane a row."""
    return np.ascontiguousarray(np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T)


def planes(bits: np.ndarray) -> np.ndarray:
    """(64, words): the planes packed, 64 values a word, the last word filled with 0."""
    n = bits.shape[1]
    packed = np.packbits(bits, axis=1, bitorder="little")
    out = np.zeros((bits.shape[0], -(-n // 64) * 8), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def within(difference, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Mask of the pairs in ``wanted`` (words of 64 pairs) at ``radius`` or
    fewer differing bits. ``difference(plane, blocks)`` gives the XOR of one
    plane for the chosen blocks of ``WORDS`` words; the counters are
    carry-save: ``radius + 1`` in binary is the most they need to tell apart.
    """
    n = len(wanted)
    padded = np.zeros(-(-n // WORDS) * WORDS, np.uint64)
    padded[:n] = wanted
    left = padded.reshape(-1, WORDS)
    blocks = np.flatnonzero(left.any(axis=1))
    out = np.zeros_like(left)
    digits = max(1, int(radius).bit_length())
    counters = [np.zeros((len(blocks), WORDS), np.uint64) for _ in range(digits)]
    over = ~left[blocks]  # pairs not asked for count as too far
    for plane in range(64):
        carry = difference(plane, blocks)
        for digit in range(digits):
            counters[digit], carry = counters[digit] ^ carry, counters[digit] & carry
        over |= carry
        if plane % STEP == STEP - 1:
            near = ~over & ~_above(counters, radius)
            alive = near.any(axis=1)
            if not alive.all():
                blocks, over, counters = blocks[alive], over[alive], [c[alive] for c in counters]
                if not len(blocks):
                    return out.reshape(-1)[:n]
    out[blocks] = ~over & ~_above(counters, radius)
    return out.reshape(-1)[:n]


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Pairs whose binary counter is greater than ``radius``."""
    greater = np.zeros_like(counters[0])
    equal = ~greater
    for digit in range(len(counters) - 1, -1, -1):
        if radius >> digit & 1:
            equal &= counters[digit]
        else:
            greater |= equal & counters[digit]
            equal &= ~counters[digit]
    return greater


def _packed(mask: np.ndarray) -> np.ndarray:
    return planes(mask.view(np.uint8)[None, :])[0]


def _blocked(p: np.ndarray) -> np.ndarray:
    """(planes, blocks, WORDS) of (planes, words)."""
    out = np.zeros((p.shape[0], -(-p.shape[1] // WORDS) * WORDS), np.uint64)
    out[:, : p.shape[1]] = p
    return out.reshape(p.shape[0], -1, WORDS)


def _hits(mask: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little")[:n])


def adjacent_links(values: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked index pairs inside runs of equal ``group``: each row against the
    row ``k`` places on, for all rows at once, for every ``k`` that some run has."""
    n, bits = len(values), bit_rows(values)
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    for k in range(1, n):
        same = group[k:] == group[:-k]
        if not same.any():
            break
        at = np.flatnonzero(same)  # only rows with a partner k places on
        left, right = _blocked(planes(bits[:, at])), _blocked(planes(bits[:, at + k]))
        near = within(lambda p, x, left=left, right=right: left[p][x] ^ right[p][x], _packed(np.ones(len(at), bool)), radius)
        found = at[_hits(near, len(at))]
        a.append(found)
        b.append(found + k)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2


def cross_links(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (index in left, index in right), some rows of ``left`` at a
    time against all planes of ``right``; with ``same``, only i < j."""
    n, words = len(right), -(-len(right) // 64)
    p, bits = planes(bit_rows(right)), bit_rows(left)
    wide = -(-words // WORDS) * WORDS
    p = np.pad(p, ((0, 0), (0, wide - words)))
    valid = np.pad(_packed(np.ones(n, bool)), (0, wide - words))
    rows = max(1, (1 << 15) // wide)
    per = wide // WORDS
    shaped = p.reshape(64, per, WORDS)
    for at in range(0, len(left), rows):
        some = bits[:, at : at + rows].astype(np.uint64) * np.uint64(0xFFFFFFFFFFFFFFFF)
        m = some.shape[1]
        near = within(lambda q, x, some=some: shaped[q][x % per] ^ some[q][x // per][:, None], np.tile(valid, m), radius)
        hit = np.flatnonzero(near)
        if not len(hit):
            continue
        word = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, bit = np.nonzero(word)
        i, j = at + hit[k] // wide, hit[k] % wide * 64 + bit
        keep = i < j if same else np.ones(len(i), bool)
        yield i[keep], j[keep]


# ------------------------------------------------------------ buckets


def _buckets(radius: int) -> list[int]:
    """Masks of the key bits, one for each pair of ``radius + 2`` blocks."""
    cuts = np.linspace(0, 64, radius + 3).round().astype(int)
    blocks = [((1 << int(e - s)) - 1) << int(s) for s, e in itertools.pairwise(cuts)]
    return [a | b for a, b in itertools.combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(fps: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """``(src, dst)``: a spanning forest of every bucket of distinct ``fp``."""
    keyed = fps.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in _buckets(radius)])).alias("t", "key")
    )
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    tasks = (
        keyed.join(sizes, ["t", "key"])
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("t", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "fp")
    )
    keys = ["t", "key", "lo", "hi"]
    tasks = tasks.repartition(*keys).sortWithinPartitions(*keys, "own", "fp")

    def links(t: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        """Of whole buckets, in order."""
        fp = t["fp"].view(np.uint64)
        change = np.flatnonzero(np.any([t[k][1:] != t[k][:-1] for k in keys], axis=0)) + 1
        starts = np.concatenate(([0], change))
        counts = np.diff(np.concatenate((starts, [len(fp)])))
        group = np.repeat(np.arange(len(starts)), counts)
        small = np.flatnonzero(np.repeat(counts <= SMALL, counts))
        i, j = adjacent_links(fp[small], group[small], radius)
        found = [(small[i], small[j])]
        for s, n in zip(starts[counts > SMALL].tolist(), counts[counts > SMALL].tolist(), strict=True):
            if t["lo"][s] == t["hi"][s]:
                pairs = ((s + x, s + y) for x, y in cross_links(fp[s : s + n], fp[s : s + n], radius, True))
            else:  # two blocks of one bucket; each block is also compared with itself
                cut = s + int(np.searchsorted(t["own"][s : s + n], t["hi"][s]))
                pairs = ((s + x, cut + y) for x, y in cross_links(fp[s:cut], fp[cut : s + n], radius, False))
            root = np.arange(s, s + n)
            for x, y in pairs:  # keep the forest, not the pairs
                new = local_roots(n, np.concatenate((np.arange(n), x - s)), np.concatenate((root - s, y - s)))
                root = new + s
            found.append((np.arange(s, s + n), root))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        root = local_roots(len(fp), a, b)
        moved = np.flatnonzero(root != np.arange(len(fp)))
        if not len(moved):
            return None
        return pa.RecordBatch.from_arrays([int64(t["fp"][moved]), int64(t["fp"][root[moved]])], ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            if held is not None:
                t = {c: np.concatenate((held[c], t[c])) for c in t}
            same = np.all([t[k] == t[k][-1] for k in keys], axis=0)
            last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0  # where the last bucket begins
            held = {c: v[last:] for c, v in t.items()}
            if last and (out := links({c: v[:last] for c, v in t.items()})) is not None:
                yield out
        if held is not None and (out := links(held)) is not None:
            yield out

    return tasks.mapInArrow(run, "src long, dst long")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row for each row of ``docs``.

    ``component_id`` is the smallest id reachable over links. Null and empty
    texts have fingerprint 0 and link like any other. Null ids link too but
    never name a component; a component of null ids alone is named null.
    Repeated rows stay repeated. Other columns of ``docs`` are not read, so
    their names cannot clash.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col), "fp")
    return components(fps, radius, block).select("doc_id", "fp", "component_id")


def components(fps: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """``fps`` (doc_id, fp, ...) with ``component`` (one of its fingerprints)
    and ``component_id`` (its smallest id)."""
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp-classes")
    parts = connected_components(fingerprint_links(classes.select("fp"), radius, block))
    labelled = classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    # Written, so that a large component's rows can be dealt to several tasks of the join.
    names = written(labelled.groupBy("component").agg(F.min("least").alias("component_id")), "fp-components")
    return fps.join(labelled.join(names, "component").select("fp", "component", "component_id"), "fp")


def hex_fingerprint(column: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def representatives(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of
    the smallest id (null ids after all others), then of the smallest hash of
    the text; of rows equal in both, one stays."""
    key = {"_llm_id": F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")), "_llm_null": F.col(id_col).isNull(), "_llm_row": row_key(text_col)}
    names = docs.columns
    keyed = docs.withColumns(key)
    found = components(written(fingerprints(keyed, shingle, id_col, text_col, [*key]), "fp"), radius)
    first = F.min(F.struct("_llm_null", "_llm_id", "_llm_row")).alias("k")
    kept = found.groupBy("component").agg(first).select("k.*")
    rows = keyed.join(kept, [*key], "left_semi")
    again = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))  # rows repeated as they are
    return rows.withColumn("_llm_nth", again).filter("_llm_nth = 1").select(*names)
