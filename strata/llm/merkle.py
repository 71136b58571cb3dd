"""Merkle manifest of a dataset, with proofs made by octopus multiproof.

Every row is a leaf. The leaves of a group, in order, are the lowest level of
a tree of fan-out ``FAN``; the roots of the groups, in order, are the leaves of
one more tree, whose root stands for the dataset. A node's digest is the
SHA-256 of its children's digests (hex text, concatenated); the last node of a
level may have fewer children. A tree of one leaf has that leaf as root.

Building. Leaves are ranked inside their group by ranges (``ordered.running``),
so a group that holds a third of all rows is no hot task; each level is one
aggregation of at most ``FAN`` rows a node.

Proving. A proof lists the siblings on the way from a leaf to the root. Leaves
are proven by partitions: all proofs of a partition share one multiproof. The
partition first computes the coordinates of the nodes that its own leaves do
not give (the minimal union over its leaves), fetches each of them once by a
join, derives the interior nodes that its leaves share, and expands the proof
of every leaf locally. A partition of consecutive leaves asks for at most
2 * (FAN - 1) nodes a level, whatever its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.ordered import running

FAN = 8
#: Leaves a part may hold on average; a task proves one part at a time.
PART = 100_000
#: The tree over the groups' roots; groups are numbered from 0.
TOP = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """The leaf of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def levels_of(n: int) -> list[int]:
    """Nodes on each level of a tree of ``n`` leaves, leaves first."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


@dataclass
class Tree:
    """``leaves``: part, g (number of the group), idx, n (leaves of the group),
    h, and the rows' own columns. ``nodes``: g, level, idx, h; the groups' trees
    and, as group ``TOP``, the tree over their roots. ``n_groups`` and ``root``
    (hex; None without rows) are single values."""

    leaves: DataFrame
    nodes: DataFrame
    n_groups: int
    root: str | None


def _grown(leaves: DataFrame) -> list[DataFrame]:
    """(g, level, idx, n, h) of the levels above the leaves (g, idx, n, h), each a written table."""
    most = leaves.agg(F.max("n").alias("n")).first()["n"] or 0
    out, at = [], leaves
    for level in range(1, len(levels_of(most))):
        children = F.array_sort(F.collect_list(F.struct("idx", "h")))  # at most FAN
        text = F.array_join(F.transform(children, lambda x: F.lower(F.hex(x["h"]))), "")
        up = (
            at.filter("n > 1").groupBy("g", F.expr(f"idx div {FAN}").alias("up"), "n")
            .agg(F.unhex(F.sha2(text.cast("binary"), 256)).alias("h"))
            .select("g", F.lit(level).alias("level"), F.col("up").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), "h")
        )
        at = written(up, f"merkle-level{level}")
        out.append(at)
    return out


def _all(leaves: DataFrame, upper: list[DataFrame]) -> DataFrame:
    out = leaves.select("g", F.lit(0).alias("level"), "idx", "n", "h")
    for x in upper:
        out = out.unionByName(x)
    return out


def build(rows: DataFrame, group: str, order: str, leaf: str = "h") -> Tree:
    """The tree over ``rows``; ``leaf`` is the column of the 32-byte digests.

    Leaves ascend by ``order`` inside their group, null first; ties ascend by
    digest (equal digests change nothing by their order). Groups ascend
    bytewise, null first. Neither may hold further columns named ``part``,
    ``pos``, ``g``, ``n`` or ``idx``.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART))
    ranked = running(rows, [group], [F.col(order).asc_nulls_first(), F.col(leaf)], name="merkle-leaves", parts=parts)
    sizes = written(ranked.groupBy(group).agg(F.count(F.lit(1)).alias("n")), "merkle-groups")
    numbered = running(sizes, [], [F.col(group).asc_nulls_first()], name="merkle-order").select(
        F.col(group).alias("_group"), "n", F.col("pos").alias("g")
    )
    n_groups = sizes.count()
    leaves = ranked.join(numbered, F.col(group).eqNullSafe(F.col("_group"))).drop("_group").withColumnRenamed("pos", "idx")
    if leaf != "h":
        leaves = leaves.withColumnRenamed(leaf, "h")
    trees = _all(leaves, _grown(leaves))
    heads = written(trees.filter("n = 1").select(F.lit(TOP).cast("long").alias("g"), F.col("g").alias("idx"), F.lit(n_groups).cast("long").alias("n"), "h"), "merkle-heads")
    top = _all(heads, _grown(heads))
    root = top.filter("n = 1").first()
    nodes = trees.unionByName(top).select("g", "level", "idx", "h")
    return Tree(leaves, nodes, n_groups, root and bytes(root["h"]).hex())


def missing(known: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, places) of the nodes that prove the leaves ``known`` (sorted,
    distinct) of a tree of ``n`` leaves and do not follow from them."""
    for level, size in enumerate(levels_of(n)[:-1]):
        up = np.unique(known // FAN)
        children = (up[:, None] * FAN + np.arange(FAN)).ravel()
        yield level, np.setdiff1d(children[children < size], known, assume_unique=True)
        known = up


def requests(tree: Tree, wanted: DataFrame) -> DataFrame:
    """``(part, g, level, idx)``: the nodes each part of ``wanted`` (leaves of
    the tree) lacks, each once."""
    n_groups = tree.n_groups

    def of(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        g, idx, n = (table.column(c).to_numpy() for c in ("g", "idx", "n"))
        order = np.lexsort((idx, g))
        groups, starts = np.unique(g[order], return_index=True)
        out: list[tuple[int, int, np.ndarray]] = []
        for one, mine in zip(groups.tolist(), np.split(order, starts[1:]), strict=True):
            out += [(one, level, x) for level, x in missing(np.unique(idx[mine]), int(n[mine[0]]))]
        out += [(TOP, level, x) for level, x in missing(groups, n_groups)]
        sizes = [len(x) for _, _, x in out]
        column = lambda k, kind: pa.array(np.repeat([x[k] for x in out], sizes), kind)
        places = np.concatenate([x for _, _, x in out]) if out else np.zeros(0, np.int64)
        return pa.table(
            {"part": pa.array([part] * sum(sizes), pa.int32()), "g": column(0, pa.int64()), "level": column(1, pa.int32()), "idx": pa.array(places, pa.int64())}
        )

    return wanted.select("part", "g", "idx", "n").groupBy("part").applyInArrow(of, "part int, g long, level int, idx long")


class _Shared:
    """Nodes of one tree that a part's leaves and its fetched nodes give."""

    def __init__(self, n: int, leaves: dict[int, str], fetched: dict[tuple[int, int], str]):
        self.levels: list[dict[int, str]] = [leaves]
        #: Siblings before and after each known node, level by level.
        self.sides: list[dict[int, tuple[str, str]]] = []
        for level, size in enumerate(levels_of(n)[:-1]):
            known, up, sides = self.levels[level], {}, {}
            for parent in dict.fromkeys(i // FAN for i in known):
                places = range(parent * FAN, min(parent * FAN + FAN, size))
                digests = [known[i] if i in known else fetched[level, i] for i in places]
                up[parent] = digest(*digests)
                for k, i in enumerate(places):
                    if i in known:
                        sides[i] = ("".join(digests[:k]), "".join(digests[k + 1 :]))
            self.sides.append(sides)
            self.levels.append(up)
        self.root = self.levels[-1][0]
        tails = {0: ""}  # siblings from a node up to the root
        for sides in reversed(self.sides):
            tails = {i: a + b + tails[i // FAN] for i, (a, b) in sides.items()}
        self.proofs = tails

    def fold(self, i: int, value: str) -> str:
        """The root, had leaf ``i`` this value."""
        for sides in self.sides:
            a, b = sides[i]
            value = digest(a, value, b)
            i //= FAN
        return value


PROVEN = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(tree: Tree, wanted: DataFrame) -> DataFrame:
    """Proofs of the leaves ``wanted``: rows of ``tree.leaves`` (all of them, or
    a selection) with ``doc_id`` and ``claim``, the digest to verify against the
    published root (null: the leaf itself).

    ``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``.
    """
    published, n_groups = tree.root, tree.n_groups
    asked = requests(tree, wanted)
    fetched = asked.join(tree.nodes, ["g", "level", "idx"]).select("part", "g", "level", "idx", "h")

    def expand(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        got: dict[int, dict[tuple[int, int], str]] = {}
        for g, level, i, h in zip(*[nodes.column(c).to_pylist() for c in ("g", "level", "idx", "h")], strict=True):
            got.setdefault(g, {})[level, i] = h.hex()
        g, idx = leaves.column("g").to_pylist(), leaves.column("idx").to_pylist()
        h = [x.hex() for x in leaves.column("h").to_pylist()]
        claim = leaves.column("claim").to_pylist()
        own: dict[int, dict[int, str]] = {}
        size: dict[int, int] = {}
        for k, i, x, n in zip(g, idx, h, leaves.column("n").to_pylist(), strict=True):
            own.setdefault(k, {})[i] = x
            size[k] = n
        trees = {k: _Shared(size[k], x, got.get(k, {})) for k, x in own.items()}
        top = _Shared(n_groups, {k: t.root for k, t in trees.items()}, got.get(TOP, {})) if trees else None
        proofs, folded = [], []
        for k, i, x, c in zip(g, idx, h, claim, strict=True):
            proofs.append(digest(trees[k].proofs[i], top.proofs[k]))
            folded.append(top.fold(k, trees[k].fold(i, x if c is None else c.hex())))
        return pa.table(
            {
                "doc_id": leaves.column("doc_id"), "leaf": pa.array(h, pa.string()), "subroot": pa.array([trees[k].root for k in g], pa.string()),
                "root": pa.array([top.root for _ in g] if top else [], pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array(folded, pa.string()), "verified": pa.array([x == published for x in folded], pa.bool_()),
            }
        )

    rows = wanted.select("part", "g", "idx", "n", "h", "doc_id", "claim")
    return rows.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(expand, PROVEN)


def document_leaves(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", n_chars_col: str = "n_chars") -> DataFrame:
    """``(doc_id, lang, h, claim)``: each row's leaf, and the leaf a tampered
    copy would have (null where the copy is not tampered with).

    The copy of a row whose id's crc32 (decimal text) is divisible by 3 has its
    text's A-Z lower-cased; a null id is not tampered with, a null text stays.
    """
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col)
    values = lambda t: (doc_id, F.col(source_col), F.col(lang_col), F.col(n_chars_col).cast("long"), t)
    forged = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return docs.select(
        doc_id.alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), leaf_digest(*values(text)).alias("h"),
        F.when(forged, leaf_digest(*values(F.translate(text, UPPER, LOWER)))).alias("claim"),
    )


def manifest(docs: DataFrame, **columns: str) -> DataFrame:
    """The proof of every row of ``docs``, verified against a partly tampered copy.

    Rows that share an id ascend by their leaf; null ids come first. Repeated
    rows are leaves of their own. A null lang is a group like any other, before
    the rest. An empty table gives no rows. Columns beside the five hashed ones
    are not read.
    """
    leaves = written(document_leaves(docs, **columns), "merkle-rows")  # texts are read and hashed once
    tree = build(leaves, "lang", "doc_id")
    return prove(tree, tree.leaves)


#: unsigned crc32 of a text in DuckDB, as columns of a table of bytes: the table by the polynomial, eight steps an entry.
CRC_TABLE = """crc_steps(b, k, v) AS (
  SELECT b, 0, b::BIGINT FROM range(256) t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(v ORDER BY b) AS crc FROM crc_steps WHERE k = 8)"""


def sql_crc32(text: str) -> str:
    """DuckDB: unsigned crc32 of an ASCII text, beside a row of ``crc_table``."""
    bytes_ = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295)"


def _sql_field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _sql_sides(nodes: str) -> str:
    """Siblings before and after each node of ``nodes`` (g, level, idx, n, h)."""
    return f"""SELECT g, level, idx, array_to_string(r[1:idx % {FAN}], '') AS a, array_to_string(r[idx % {FAN} + 2:], '') AS b FROM (
      SELECT g, level, idx, n, list(h ORDER BY idx) OVER (PARTITION BY g, level, idx // {FAN} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS r
      FROM {nodes}) WHERE n > 1"""


def _sql_levels(name: str, leaves: str) -> str:
    return f"""{name}(g, level, idx, n, h) AS (
  SELECT g, 0, idx, n, h FROM {leaves}
  UNION ALL SELECT g, level + 1, idx // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY idx)) FROM {name}
  WHERE n > 1 GROUP BY g, level, idx // {FAN}, (n + {FAN - 1}) // {FAN}
)"""


#: DuckDB SQL for the contract's query: levels and walks to the root by recursion.
SQL = f"""
WITH RECURSIVE {CRC_TABLE}, l AS (
  SELECT doc_id, {_sql_leaf("text")} AS h, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    CASE WHEN {sql_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS claim
  FROM documents, crc_table
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM l
), {_sql_levels("nodes", "leaves")}, heads AS (
  SELECT -1 AS g, g AS idx, count(*) OVER () AS n, h FROM nodes WHERE n = 1
), {_sql_levels("top", "heads")}, sides AS ({_sql_sides("nodes")}), top_sides AS ({_sql_sides("top")}),
walk(doc_id, leaf, g, level, idx, proof, v) AS (
  SELECT doc_id, h, g, 0, idx, '', coalesce(claim, h) FROM leaves
  UNION ALL SELECT doc_id, leaf, g, level + 1, idx // {FAN}, proof || a || b, sha256(a || v || b) FROM walk JOIN sides USING (g, level, idx)
), climb(doc_id, leaf, g, subroot, level, idx, proof, v) AS (
  SELECT doc_id, leaf, w.g, h, 0, w.g, proof, v FROM walk w JOIN nodes o ON w.g = o.g AND w.level = o.level AND n = 1
  UNION ALL SELECT doc_id, leaf, c.g, subroot, c.level + 1, c.idx // {FAN}, proof || a || b, sha256(a || v || b)
  FROM climb c JOIN top_sides s ON c.level = s.level AND c.idx = s.idx
)
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, v AS folded_root, v = h AS verified
FROM climb c JOIN top t ON c.level = t.level AND t.n = 1
"""
