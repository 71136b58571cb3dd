"""Prefix trie of conversations by whole-sequence collapse.

Each conversation is rebuilt as a sequence of turns; each distinct prefix of
such a sequence is a node of the trie. Turn by turn insertion would touch every
node once for every conversation. Instead:

1. Identical rebuilt conversations are grouped into one weighted sequence with
   the list of the conversations that end there. Only the turns of one
   conversation of each group go on.
2. Sequences that are proper prefixes of others are dropped by an anti-join of
   the sequences against their own prefixes: what stays are the leaves.
3. Weighted prefixes are aggregated into nodes.

A prefix is named by its length and 128 bits: the running XOR of two 64-bit
hashes of (place, digest of the turn). Turns are placed, and prefixes hashed,
by ranges (``ordered.running``), so a conversation of any length spans tasks.

Sums over subtrees need no walk: a node belongs to the smallest leaf sequence
through it, so each leaf owns the lower end of its path. The sum over a
subtree is the running sum up its owner's path plus the whole owned paths of
the other leaves through the node, which is one more aggregation of prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows, written
from strata.llm.merkle import CRC_TABLE, sql_crc32
from strata.llm.ordered import running

#: A conversation shares the first turns of the first one of its block of ids.
BLOCK = 100
HEADS = 6
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "p1", "p2"]


def n_shared(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its block: 0 to HEADS - 1."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("long")


def original_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, m, chars, pos)``: every turn's digest, code points and place
    in its conversation, by turn (null first), then by digest."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    m = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), m.alias("m"), F.length(text).cast("long").alias("chars")
    )
    return running(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("m")], name="trie-turns").drop("part", "turn")


def rebuilt_turns(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``(conv_id, pos, m, chars)`` of the rebuilt conversations.

    ``convs`` is (conv_id, n). A block has at most ``BLOCK`` conversations, and
    only the first turns of its first one are copied to them.
    """
    of_block = convs.filter(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("block"), F.col("n").alias("first_n"))
    block = F.col("conv_id") - F.col("conv_id") % BLOCK
    firsts = turns.filter((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < HEADS - 1)).withColumnRenamed("conv_id", "block")
    shared = convs.select("conv_id", block.alias("block"), n_shared(F.col("conv_id")).alias("h")).join(firsts, "block").filter("pos < h")
    own = turns.withColumn("h", n_shared(F.col("conv_id"))).filter("pos >= h").withColumn("block", block).join(of_block, "block", "left")
    at = F.col("pos") - F.col("h") + F.least("h", F.coalesce("first_n", F.lit(0)))
    return shared.select("conv_id", "pos", "m", "chars").unionByName(own.select("conv_id", at.alias("pos"), "m", "chars"))


def _end_lists(ends: DataFrame) -> DataFrame:
    """``(depth, p1, p2, conv_id)``, one row a conversation, to one row a sequence:
    ``weight``, ``conv_id`` (the smallest) and ``ends_sha256``.

    Ids are dealt by ranges and joined into pieces of text in parallel; what
    hashes a sequence's list in one task, streaming, are those pieces.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [batch.column(c).to_numpy() for c in KEY]
        new = [0] + [i for i in range(1, batch.num_rows) if any(k[i] != k[i - 1] for k in keys)]
        ids = pc.cast(batch.column("conv_id"), pa.string())
        until = new[1:] + [batch.num_rows]
        take = pa.array(new)
        return pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(take) for c in KEY], batch.column("conv_id").take(take),
                pa.array([b - a for a, b in zip(new, until, strict=True)], pa.int64()),
                pa.array([",".join(ids.slice(a, b - a).to_pylist()) for a, b in zip(new, until, strict=True)], pa.string()),
            ],
            [*KEY, "conv_id", "n", "ids"],
        )

    order = [*KEY, "conv_id"]
    dealt = written(ends, "trie-ends").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    listed = map_rows(dealt, pieces, "depth long, p1 long, p2 long, conv_id long, n long, ids string")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, weight, first = None, None, 0, None

        def done(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            kinds = [pa.int64()] * 5 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], [*KEY, "conv_id", "weight", "ends_sha256"])

        for batch in batches:
            rows = []
            for *k, conv, n, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "conv_id", "n", "ids")], strict=True):
                if k != key:
                    if key is not None:
                        rows.append((*key, first, weight, sha.hexdigest()))
                    key, sha, weight, first = k, hashlib.sha256(ids.encode()), n, conv
                else:
                    sha.update(b"," + ids.encode())
                    weight += n
            if rows:
                yield done(rows)
        if key is not None:
            yield done([(*key, first, weight, sha.hexdigest())])

    by_sequence = listed.repartition(parts, *KEY).sortWithinPartitions(*order)
    return by_sequence.mapInArrow(hashed, "depth long, p1 long, p2 long, conv_id long, weight long, ends_sha256 string")


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node: ``(conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256)``.

    Null roles and texts are empty. Turns that tie stand in the order of the
    digest of role and text, repeated rows are turns of their own. Rows without
    a conv_id belong to no conversation and are left out. A conversation that
    is rebuilt without turns ends at the root. An empty table has no nodes, not
    even a root. Other columns are not read.
    """
    turns = original_turns(conversations, conv_col, turn_col, role_col, text_col)
    convs = written(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-conversations")
    e = [F.xxhash64(F.lit(seed), "pos", "m").alias(f"p{seed}") for seed in (1, 2)]
    rebuilt = rebuilt_turns(turns, convs).select("conv_id", F.col("pos").alias("depth"), "chars", *e).withColumns({"e1": F.col("p1"), "e2": F.col("p2")})
    prefixes = running(rebuilt, ["conv_id"], [F.col("depth")], xors=["p1", "p2"], name="trie-prefixes").drop("part", "pos").withColumn("depth", F.col("depth") + 1)

    # 1. One weighted sequence for identical conversations.
    last = prefixes.groupBy("conv_id").agg(F.max_by(F.struct(*KEY), "depth").alias("k")).select("conv_id", *[F.col(f"k.{c}") for c in KEY])
    empty = F.lit(0).cast("long")
    ends = convs.select("conv_id").join(last, "conv_id", "left").select("conv_id", *[F.coalesce(c, empty).alias(c) for c in KEY])
    sequences = written(_end_lists(ends), "trie-sequences")
    paths = written(prefixes.join(sequences.select("conv_id", F.col("depth").alias("length"), "weight"), "conv_id"), "trie-paths")

    # 2. A sequence that is a proper prefix of another is no leaf.
    proper = paths.filter("depth < length").select(*KEY).distinct()
    leaves = written(sequences.filter("depth > 0").join(proper, KEY, "left_anti").select("conv_id", F.lit(True).alias("leaf")), "trie-leaves")

    # 3. Weighted prefixes to nodes. A node's parent is named by taking its last turn out of the XOR.
    flagged = paths.join(leaves, "conv_id", "left")
    parent = [F.col(f"p{k}").bitwiseXOR(F.col(f"e{k}")).alias(f"q{k}") for k in (1, 2)]
    nodes = written(
        flagged.select("*", *parent).groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count("leaf").alias("n_leaves"),
            F.min(F.when(F.col("leaf"), F.col("conv_id"))).alias("owner"), F.max("q1").alias("q1"), F.max("q2").alias("q2"),
            (F.max("chars") * (F.sum("weight") - 1)).alias("saved"),
        ),
        "trie-nodes",
    )

    # Sums over subtrees, children and end lists meet in one aggregation.
    upward = running(nodes, ["owner"], [F.col("depth").desc()], sums=["saved"], name="trie-upward").drop("part", "pos")
    owned = nodes.groupBy("owner").agg(F.sum("saved").alias("saved"), F.min("depth").alias("from")).withColumnRenamed("owner", "conv_id")
    others = paths.select("conv_id", *KEY).join(owned, "conv_id").filter(F.col("depth") < F.col("from")).groupBy(*KEY).agg(F.sum("saved").alias("saved"))
    children = nodes.select((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    gathered = (
        upward.drop("owner")
        .unionByName(others, allowMissingColumns=True)
        .unionByName(children.filter("depth > 0"), allowMissingColumns=True)
        .unionByName(sequences.filter("depth > 0").select(*KEY, "ends_sha256"), allowMissingColumns=True)
        .groupBy(*KEY)
        .agg(
            *[F.max(c).alias(c) for c in ("conv_id", "n_convs", "n_leaves", "q1", "q2", "ends_sha256")],
            F.coalesce(F.sum("n_children"), empty).alias("n_children"), F.sum("saved").alias("saved_tokens"),
        )
    )
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    below = gathered.join(above, ["depth", "q1", "q2"], "left")  # the first turns have no such parent: theirs is the root

    x = sequences.agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max(F.when(F.col("depth") == 0, F.col("ends_sha256"))).alias("ends"),
    ).first()
    y = nodes.agg(F.count(F.when(F.col("depth") == 1, 1)).alias("n"), F.sum("saved").alias("saved")).first()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    below = below.withColumns(
        {
            "parent_conv_id": F.when(F.col("depth") == 1, F.lit(x["conv_id"])).otherwise(F.col("parent_conv_id")).cast("long"),
            "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY_SHA)),
        }
    )
    top = [(x["conv_id"], 0, None, x["n_convs"], y["n"], max(leaves.count(), 1), y["saved"] or 0, x["ends"] or EMPTY_SHA)] if x["n_convs"] else []
    root = conversations.sparkSession.createDataFrame(top, ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in names))
    return below.select(*names).unionByName(root)


#: DuckDB SQL for the contract's query: prefixes are slices of lists of turns.
SQL = f"""
WITH RECURSIVE {CRC_TABLE}, o AS (
  SELECT conv_id, list({{'r': r, 't': t}} ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || t)) AS own FROM (
    SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id
), c AS (
  SELECT o.conv_id, list_concat(coalesce(b.own, [])[1:h], o.own[h + 1:]) AS seq
  FROM (SELECT *, {sql_crc32("conv_id::VARCHAR")} % {HEADS} AS h FROM o, crc_table) o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % {BLOCK}
), m AS (
  SELECT conv_id, len(seq) AS total, d AS depth, seq[1:d] AS p FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM c)
), n AS (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(length(p[depth].t), 0) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE total = depth), '')) AS ends_sha256
  FROM m GROUP BY depth, p
), f AS (
  SELECT n.*, k.n_children FROM n LEFT JOIN (SELECT p[1:depth - 1] AS q, depth - 1 AS j, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL) k
    ON k.j = n.depth AND k.q = n.p
), s AS (
  SELECT p[1:j] AS p, j AS depth, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS j FROM f) GROUP BY ALL
)
SELECT f.conv_id, f.depth, u.conv_id AS parent_conv_id, f.n_convs, coalesce(f.n_children, 0) AS n_children, n_leaves,
  saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN s ON f.depth = s.depth AND f.p = s.p LEFT JOIN n u ON u.depth = f.depth - 1 AND u.p = f.p[1:f.depth - 1]
"""
