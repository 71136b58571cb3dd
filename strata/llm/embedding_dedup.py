"""Embedding near-duplicates by a forest of random-projection trees.

A tree splits the vectors again and again by a random direction, at the median
of their projections or where far fewer of them are close to the split. Vectors
near a split go to both sides (spill), so a pair of near vectors is rarely
parted, and a pair parted in one tree meets in another. The band that spills is
never narrow against the distance of two linked vectors, and a node as narrow
as that distance (a crowd of near copies) is split no further. Vectors that
meet in a leaf of any tree are compared by cosine in double precision; links
are united.

Scale: the trees (directions, medians) come from a bounded sample of
``FIT_ROWS`` vectors and are a few MB; every vector is put into the leaves of
every tree. Trees are shared by all labels; a label with few vectors stops
higher up, where a leaf already holds about ``LEAF`` of them, and one that is
not split at all goes through one tree. Vectors equal in
every component are one class and go through the trees once. A leaf that is
larger than ``BLOCK`` all the same (a crowd of near copies is not split) is
cut into blocks compared pair by pair in tasks of their own. Rows that share
an earlier leaf, as a crowd does in every tree, are not compared again.

A pair that meets in several leaves is counted in the first of them, which both
sides can tell from the leaves they carry. So a leaf gives one count for each
vector and a spanning forest of its links; pairs are never written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, int64, local_roots, written

LEAST_COSINE = 0.93
TREES = 8
LEAF = 512
#: Half-width of the band that goes to both sides, in standard deviations of the projections.
SPILL = 0.2
#: Least half-width of the band, in standard deviations of a linked pair's projected difference.
REACH_SPILL = 0.5
FIT_ROWS = 20000
MAX_DEPTH = 24
BLOCK = 4096
SEED = 4


class Forest:
    """``trees`` trees over unit vectors of ``dim`` components.

    Node numbers follow a heap: the root is 1, the children of n are 2n and
    2n + 1. Directions come from the seed and the node's number. Splits and
    spreads are fitted while at least ``least`` sample rows reach a node; below,
    a node splits at its direction's value at the centre of the last fitted one.
    ``radius`` is the largest distance of linked vectors.
    """

    def __init__(self, sample: np.ndarray, trees: int, depth: int, spill: float, seed: int, radius: float, least: int = 32) -> None:
        self.dim, self.trees, self.spill, self.seed = sample.shape[1], trees, spill, seed
        self.reach = radius / self.dim**0.5  # of a linked pair along a random direction
        self.splits: list[dict[int, tuple[float, float]]] = []
        self.centres: list[dict[int, tuple[np.ndarray, float, bool]]] = []
        for t in range(trees):
            splits: dict[int, tuple[float, float]] = {}
            centres: dict[int, tuple[np.ndarray, float, bool]] = {}
            todo = [(1, np.arange(len(sample)))]
            while todo:
                node, rows = todo.pop()
                x = sample[rows] if len(rows) else np.zeros((1, self.dim))
                spread = float(np.sqrt(x.var(axis=0).mean()))
                crowd = len(rows) >= least and spread <= self.reach
                if crowd or len(rows) < least or node.bit_length() > depth:
                    centres[node] = (x.mean(axis=0).astype(np.float32), spread if crowd or spread else 1.0 / self.dim**0.5, crowd)
                    continue
                p = x @ self.direction(t, node)
                splits[node] = (self.cut(p), float(p.std()))
                todo += [(2 * node, rows[p <= splits[node][0]]), (2 * node + 1, rows[p > splits[node][0]])]
            self.splits.append(splits)
            self.centres.append(centres)

    def band(self, spread: float) -> float:
        return max(self.spill * spread, REACH_SPILL * self.reach)

    def cut(self, p: np.ndarray) -> float:
        """The median, or the split with the fewest values in its band for each
        value on its smaller side, if that is clearly better: the edge of a crowd."""
        p = np.sort(p)
        share = np.linspace(0.05, 0.95, 37)
        at = np.quantile(p, share)
        band = self.band(float(p.std()))
        inside = np.searchsorted(p, at + band, "right") - np.searchsorted(p, at - band)
        score = inside / np.minimum(share, 1 - share)
        best = int(np.argmin(score))
        return float(at[best] if score[best] < 0.75 * score[18] else at[18])

    def direction(self, tree: int, node: int) -> np.ndarray:
        v = np.random.default_rng((self.seed, tree, node)).normal(size=self.dim)
        return v / np.linalg.norm(v)

    def split(self, tree: int, node: int) -> tuple[np.ndarray, float, float]:
        d = self.direction(tree, node)
        if node in self.splits[tree]:
            return (d, *self.splits[tree][node])
        up = node
        while up not in self.centres[tree]:
            up >>= 1
        centre, spread, _ = self.centres[tree][up]
        return d, float(centre @ d), spread

    def leaves(self, x: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that each of the unit vectors falls into;
        ``depth`` gives the levels that each is to go down. A leaf is the
        tree's number times 2^40 plus the node's."""
        rows_out, leaves_out = [], []
        for t in range(self.trees):
            # A label that no tree splits is one leaf: one tree is enough.
            todo = [(1, np.arange(len(x)) if t == 0 else np.flatnonzero(depth > 0))]
            while todo:
                node, rows = todo.pop()
                if not len(rows):
                    continue
                crowd = self.centres[t].get(node, (None, 0.0, False))[2]
                done = (depth[rows] < node.bit_length()) | crowd
                if done.any():
                    rows_out.append(rows[done])
                    leaves_out.append(np.full(int(done.sum()), (t << 40) + node, np.int64))
                    rows = rows[~done]
                    if not len(rows):
                        continue
                d, middle, spread = self.split(t, node)
                p = x[rows] @ d - middle
                band = self.band(spread)
                todo += [(2 * node, rows[p <= band]), (2 * node + 1, rows[p > -band])]
        return np.concatenate(rows_out), np.concatenate(leaves_out)


def _matrix(column: pa.Array) -> np.ndarray:
    """(n, dim) doubles of lists of one length without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _usable(embedding: str, label: str):
    """Has a label, and finite components that are not all zero."""
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(F.col(label).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def vector_classes(vectors: DataFrame) -> DataFrame:
    """``vectors`` (vec_id, label, embedding) with ``k``: a 128-bit hash of label and components."""

    @F.arrow_udf("binary")
    def hashes(labels: pa.Array, x: pa.Array) -> pa.Array:
        out = []
        for lab, v in zip(labels.to_pylist(), x.to_pylist(), strict=True):
            data = (np.array(v, np.float64) + 0.0).tobytes()  # -0.0 is 0.0
            out.append(xxhash.xxh3_128_digest(lab.encode() + b"\0" + data))
        return pa.array(out, pa.binary())

    return vectors.withColumn("k", hashes("label", "embedding"))


def near_duplicates(
    vectors: DataFrame, least: float = LEAST_COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, fit_rows: int = FIT_ROWS, block: int = BLOCK,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Vectors link when their labels are equal and their cosine is at least
    ``least``; vectors of different length never do. Vectors that are null,
    zero, or hold null or non-finite components, and those without a label,
    link with nothing: their component is their own id. Rows are vectors:
    repeated rows link with each other, also those that share an id. A null id
    links like any other but names no component; a component of null ids alone
    is named null, and a null id is never kept. Other columns are not read.
    """
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # floats cross shuffles as they are
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast(kind).alias("embedding"))
    usable = written(vector_classes(rows.filter(_usable("embedding", "label"))), "vectors")
    rest = rows.filter(~_usable("embedding", "label")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")
    )
    classes = written(
        usable.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("label").alias("label"), F.first("embedding").alias("x")),
        "vector-classes",
    )
    counts, stars = _compared(classes, least, trees, leaf, spill, fit_rows, block)
    parts = connected_components(stars)
    linked = counts.groupBy("k").agg(F.sum("links").alias("links"))
    named = (
        classes.select("k", "n", "least")
        .join(linked, "k", "left")
        .join(parts.withColumnRenamed("node", "k"), "k", "left")
        .withColumn("component", F.coalesce("component", "k"))
    )
    # Written, so that a large component's rows can be dealt to several tasks of the join.
    ids = written(named.groupBy("component").agg(F.min("least").alias("component_id")), "vector-components")
    n_links = (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links")
    found = usable.select("vec_id", "k").join(named.join(ids, "component").select("k", n_links, "component_id"), "k")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return found.select("vec_id", "n_links", "component_id", kept).unionByName(rest)


def _compared(classes: DataFrame, least: float, trees: int, leaf: int, spill: float, fit_rows: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Counts of linked vectors for each class and a spanning forest of links."""
    sized = classes.withColumn("dim", F.size("x"))
    groups = sized.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("rows"))
    depth = F.greatest(F.lit(0), F.least(F.lit(MAX_DEPTH), F.ceil(F.log2(F.col("rows") / leaf)).cast("int"))).alias("depth")
    with_depth = sized.join(groups.select("label", "dim", depth), ["label", "dim"])
    sample = sized.orderBy("k").limit(fit_rows).select("x", "dim").toArrow().combine_chunks()  # hash order: a uniform sample
    forests: dict[int, Forest] = {}
    dims_seen = sample.column("dim").to_numpy()
    for dim in np.unique(dims_seen).tolist():
        x = _matrix(sample.filter(pa.array(dims_seen == dim)).column("x").combine_chunks())
        forests[dim] = Forest(x / np.linalg.norm(x, axis=1, keepdims=True), trees, MAX_DEPTH, spill, SEED, (2 - 2 * least) ** 0.5)

    kind = classes.schema["x"].dataType.simpleString()
    schema = f"leaf long, leaves array<long>, label string, dim int, k binary, n long, x {kind}"
    names = ["leaf", "leaves", "label", "dim", "k", "n", "x"]

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 1024):
                batch = big.slice(at, 1024)
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    some = batch.filter(pa.array(dims == dim))
                    x = _matrix(some.column("x"))
                    u = x / np.linalg.norm(x, axis=1, keepdims=True)
                    forest = forests.get(dim)
                    if forest is None:  # a length that the sample does not hold: no split
                        row, node = np.arange(len(u)), np.ones(len(u), np.int64)
                    else:
                        row, node = forest.leaves(u, some.column("depth").to_numpy())
                    order = np.lexsort((node, row))
                    row, node = row[order], node[order]
                    starts = np.searchsorted(row, np.arange(len(u) + 1))
                    lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(node))
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node), lists.take(take), *[some.column(c).take(take) for c in names[2:]]], names
                    )

    placed = written(with_depth.select("x", "depth", "label", "dim", "k", "n").mapInArrow(leaves, schema), "leaves")
    key = ["label", "dim", "leaf"]
    sizes = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    own = F.pmod(F.xxhash64("k"), F.col("parts")).cast("int")
    tasks = (
        placed.join(sizes, key)
        .withColumn("parts", F.ceil(F.col("rows") / block).cast("int"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("lo", F.least("own", "other"))
        .withColumn("hi", F.greatest("own", "other"))
    )
    group = [*key, "lo", "hi"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        mark = None
        for batch in batches:
            if not batch.num_rows:
                continue
            of = list(zip(*[batch.column(c).to_pylist() for c in group], strict=True))
            start = 0
            for i in range(1, len(of) + 1):
                if i == len(of) or of[i] != of[start]:
                    if held and of[start] != mark:
                        yield from _leaf_links(pa.Table.from_batches(held), least)
                        held = []
                    mark = of[start]
                    held.append(batch.slice(start, i - start))
                    start = i
        if held:
            yield from _leaf_links(pa.Table.from_batches(held), least)

    wanted = tasks.select("label", "dim", "leaf", "lo", "hi", "own", "leaves", "k", "n", "x")
    out = written(
        wanted.repartition(*group).sortWithinPartitions(*group, "own").mapInArrow(compared, "k binary, links long, root binary"),
        "leaf-links",
    )
    return out.select("k", "links"), out.filter("root <> k").select(F.col("k").alias("src"), F.col("root").alias("dst"))


def _leaf_links(t: pa.Table, least: float, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Compare one leaf, or one pair of its blocks. The pairs that the leaf is
    the first to see are counted; all links go into the forest."""
    t = t.combine_chunks()
    leaf, lo, hi = (t.column(c)[0].as_py() for c in ("leaf", "lo", "hi"))
    own = t.column("own").to_numpy()
    u = _matrix(t.column("x").combine_chunks())
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    n = t.column("n").to_numpy()
    seen = _earlier(t.column("leaves").combine_chunks(), leaf)
    left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
    links = np.zeros(len(u), np.int64)
    root = np.arange(len(u))
    # Rows that met in one earlier leaf were compared, counted and united there.
    met = _met(t.column("leaves").combine_chunks(), leaf)
    parts = [(left[~met[left]], right)] + [(left[met[left]], right[~met[right]])] * (lo != hi)
    for a, b in [(some[at : at + rows], b) for some, b in parts for at in range(0, len(some), rows)]:
        i, j = np.nonzero(u[a] @ u[b].T >= least - 1e-9)
        i, j = a[i], b[j]
        if lo == hi:
            once = (i < j) | met[j]
            i, j = i[once], j[once]
        for some in np.array_split(np.arange(len(i)), len(i) // 65536 + 1):
            x, y = i[some], j[some]
            exact = np.einsum("ij,ij->i", u[x], u[y]) >= least
            x, y = x[exact], y[exact]
            new = ~(seen[x] & seen[y]).any(axis=1)
            np.add.at(links, x[new], n[y[new]])
            np.add.at(links, y[new], n[x[new]])
            root = local_roots(len(u), np.concatenate((np.arange(len(u)), x)), np.concatenate((root, y)))
    found = np.flatnonzero((links > 0) | (root != np.arange(len(u))))
    if len(found):
        k = t.column("k").combine_chunks()
        yield pa.RecordBatch.from_arrays([k.take(pa.array(found)), int64(links[found]), k.take(pa.array(root[found]))], ["k", "links", "root"])


def _met(leaves: pa.Array, leaf: int) -> np.ndarray:
    """Which rows are in the one leaf before ``leaf`` that most of them are in."""
    node, size = leaves.flatten().to_numpy(), leaves.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(size)), size)
    row, node = row[node < leaf], node[node < leaf]
    met = np.zeros(len(size), bool)
    if len(node):
        ids, count = np.unique(node, return_counts=True)
        met[row[node == ids[np.argmax(count)]]] = True
    return met


def _earlier(leaves: pa.Array, leaf: int) -> np.ndarray:
    """For each row, a bitmap of the leaves before ``leaf`` that it shares with another row."""
    node, size = leaves.flatten().to_numpy(), leaves.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(size)), size)
    row, node = row[node < leaf], node[node < leaf]
    ids, at, count = np.unique(node, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    bits = np.zeros((len(size), -(-max(1, int(shared.sum())) // 8)), np.uint8)
    keep = shared[at]
    place = number[at[keep]]
    np.bitwise_or.at(bits, (row[keep], place >> 3), np.left_shift(1, place & 7).astype(np.uint8))
    return bits


#: DuckDB SQL for the contract's query: every pair of a label.
SQL = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e, coalesce(label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, FALSE) AS ok
  FROM embeddings
), l AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.label = b.label AND a.ok AND b.ok AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {LEAST_COSINE}
), reach(r, other) AS (
  SELECT r, r FROM v UNION SELECT reach.r, l.b FROM reach JOIN l ON l.a = reach.other
), c AS (
  SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.other GROUP BY reach.r
)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = v.r)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, FALSE) AS kept
FROM v JOIN c USING (r)
"""
