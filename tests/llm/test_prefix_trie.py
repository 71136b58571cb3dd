from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from strata.llm import prefix_trie

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
#: Also columns with names that the operator uses inside.
SCHEMA = "conv_id long, turn long, role string, text string, depth string, p1 string, m string, pos string, part string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


def rebuilt_of(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn, role or "", text or ""))
    digest = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).digest()
    own = {c: [(r, t) for _, r, t in sorted(x, key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1], x[2])))] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(rows):
    rebuilt = rebuilt_of(rows)
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(who), len(node), parent, len(who), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return out


def check(spark, rows):
    got = prefix_trie.trie(table_of(spark, rows))
    assert got.columns == NAMES
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    want = sorted(brute(rows), key=key)
    assert sorted(map(tuple, got.collect()), key=key) == want
    return want


def test_random_conversations(spark):
    rng = random.Random(1)
    for _ in range(2):
        rows = []
        for c in rng.sample(range(0, 400), 150):
            for turn in range(rng.choice([1, 2, 3, 8])):
                rows.append((c, rng.choice([turn, turn, None, 2]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "long text"])))
        rng.shuffle(rows)
        assert len(check(spark, rows)) > 50


def test_nulls_repeats_turnless_and_negative_ids(spark):
    # 1: five shared turns of an absent block, so no turns are left; two rows without a conversation
    turnless = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(turnless, 0, "user", "x"), (None, 0, "user", "y"), (None, None, None, None)]
    want = check(spark, rows)
    assert [r[1] for r in want] == [0]
    rows += [(-250, None, None, None), (-250, None, None, None), (-249, 5, "user", "z" * 100_000), (300, 1, "user", "a"), (301, 1, "user", "a")]
    check(spark, rows)


def test_one_conversation_holds_a_third_of_all_turns_and_copies_are_many(spark):
    rows = [(100, t, "user", f"turn {t % 7}") for t in range(700)]
    rows += [(c, t, "user", f"turn {t % 7}") for c in range(1000, 1100) for t in range(4)]
    rows += [(c, 0, "user", "the same") for c in range(2000, 2600)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "32")
    try:
        check(spark, rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_conversations(spark):
    assert prefix_trie.trie(table_of(spark, [])).collect() == []
    assert prefix_trie.trie(table_of(spark, [(None, 1, "user", "x")])).collect() == []
