from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from strata.llm import merkle

from .helpers import docs_of, edge_rows


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, i):
    out = []
    for level in tree[:-1]:
        a = i // 8 * 8
        out.append((level[a:i], level[i + 1 : a + 8]))
        i //= 8
    return out


def brute(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    null_first = lambda r: (r[0] is not None, r[0] or 0, leaf(*r))
    members = {la: sorted((r for r in rows if r[2] == la), key=null_first) for la in langs}
    trees = {la: levels([leaf(*r) for r in members[la]]) for la in langs}
    top = levels([trees[la][-1][0] for la in langs])
    out = []
    for k, la in enumerate(langs):
        for i, r in enumerate(members[la]):
            way = siblings(trees[la], i) + siblings(top, k)
            proof = H(*[x for a, b in way for x in (*a, *b)])
            v = leaf(*(r if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 else (*r[:4], lowered(r[4]))))
            for a, b in way:
                v = H(*a, v, *b)
            out.append((r[0], leaf(*r), trees[la][-1][0], top[-1][0], proof, v, v == top[-1][0]))
    return out


def same(got, want):
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_edge_rows(spark):
    docs = docs_of(spark, edge_rows())
    same(merkle.manifest(docs).collect(), brute(rows_of(docs)))


def test_hot_language_many_languages_and_ties(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice([None, 7, i]), f"Text {i % 50}", rng.choice(["en", "en", "en", None, "", f"l{i}", "é"]), rng.choice(["s", None])) for i in range(900)
    ]
    docs = docs_of(spark, rows)
    got = merkle.manifest(docs).collect()
    same(got, brute(rows_of(docs)))
    assert {r["verified"] for r in got} == {True, False}


def test_one_row_and_one_language(spark):
    for rows in ([(5, "A b", "en", "s")], [(i, f"Text {i}", "en", None) for i in range(9)], [(None, None, None, None)]):
        docs = docs_of(spark, rows)
        same(merkle.manifest(docs).collect(), brute(rows_of(docs)))


def test_requests_are_minimal_and_whole():
    rng = np.random.default_rng(2)
    for n in (1, 2, 8, 9, 64, 65, 700):
        known = np.unique(rng.integers(0, n, rng.integers(1, n + 1)))
        asked = {(level, int(i)) for level, x in merkle.missing(known, n) for i in x}
        derived = {(0, int(i)) for i in known}
        needed = set()
        for level, size in enumerate(merkle.levels_of(n)[:-1]):
            for parent in {i // 8 for lv, i in derived if lv == level}:
                needed |= {(level, i) for i in range(parent * 8, min(parent * 8 + 8, size))} - derived
                derived.add((level + 1, parent))
        assert asked == needed


def test_a_part_of_consecutive_leaves_asks_for_few_nodes():
    for a, b in ((0, 5000), (1234, 98765), (99_999, 100_000)):
        assert all(len(x) <= 14 for _, x in merkle.missing(np.arange(a, b), 100_000))


def test_proofs_of_a_selection(spark):
    docs = docs_of(spark, [(i, f"Text {i}", "en" if i % 3 else "de", "s") for i in range(300)])
    tree = merkle.build(merkle.document_leaves(docs), "lang", "doc_id")
    some = tree.leaves.filter("doc_id % 17 = 0").withColumn("part", (F.col("doc_id") % 2).cast("int"))
    want = [r for r in brute(rows_of(docs)) if r[0] % 17 == 0]
    same(merkle.prove(tree, some).collect(), want)
    assert tree.root == want[0][3]
