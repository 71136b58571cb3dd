from __future__ import annotations

import hashlib

import numpy as np
import pytest

from strata.llm import syncmers

from .helpers import SF_TINY, docs_of, edge_rows


def brute(rows):
    """Rows of (doc_id, text) to {(doc_id, edited digest, n_chars)}."""
    order = sorted(rows, key=lambda r: -float("inf") if r[0] is None else r[0], reverse=True)
    out = []
    for j, (i, t) in enumerate(order):
        t, following = t or "", order[(j + 1) % len(order)][1] or ""
        m = len(t) // 3
        edited = t[: len(t) - m] + following[:m]
        f, e, n = (syncmers.fingerprint(x.encode()) for x in (t, edited, following))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f.astype(">u2").tobytes().hex(), e.astype(">u2").tobytes().hex(), syncmers.likeness(f, e), syncmers.likeness(f, n)))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 3, 8, 64])
def test_matches_brute_force(spark, parts):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    got = sorted(map(tuple, syncmers.edited_digest(docs, parts=parts).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_likeness_orders_edits_before_strangers(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    got = syncmers.edited_digest(docs).filter("n_chars > 400").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in got) / len(got) > 0.95


@pytest.mark.parametrize("parts", [1, 4])
def test_edge_rows(spark, parts):
    rows = [r for r in edge_rows() if r[0] not in (None, 12)]
    got = sorted(map(tuple, syncmers.edited_digest(docs_of(spark, rows), parts=parts).collect()), key=str)
    assert got == brute([(i, t) for i, t, *_ in rows])
    full = syncmers.edited_digest(docs_of(spark, edge_rows()), parts=parts).collect()  # ties and null ids
    assert len(full) == len(edge_rows())
    assert {r["n_chars"] for r in full if r["doc_id"] is None} == {0, len(edge_rows()[8][1])}


def test_one_document_follows_itself(spark):
    text = "abc" * 30
    (r,) = syncmers.edited_digest(docs_of(spark, [(1, text, "en", "s")])).collect()
    assert r["edited_sha256"] == hashlib.sha256((text[:60] + text[:30]).encode()).hexdigest() and r["near_next"] == 1.0


def test_closed_syncmers_by_definition():
    text = bytes(np.random.default_rng(0).integers(97, 101, 500, dtype=np.uint8))
    at, h = syncmers.anchors(text)
    s_hash = {}
    for i in range(len(text) - syncmers.S + 1):
        s_hash[i] = int(syncmers._mixed(np.frombuffer(text[i : i + 8], np.uint64))[0])
    want = []
    for i in range(len(text) - syncmers.K + 1):
        inner = [s_hash[j] for j in range(i, i + syncmers.K - syncmers.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            want.append(i)
    assert at.tolist() == want
    again, h2 = syncmers.anchors(b"a different beginning, " + text)  # context-free: the same anchors, moved
    moved = dict(zip(again.tolist(), h2.tolist(), strict=True))
    assert all(moved[a + 23] == v for a, v in zip(at.tolist(), h.tolist(), strict=True))


def test_document_anchors(spark):
    rows = edge_rows()
    got = syncmers.document_anchors(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sum(len(r["anchors"]) for r in got) == sum(len(syncmers.anchors((t or "").encode())[0]) for _, t, *_ in rows)


@pytest.mark.parametrize("hot", [None, 500])
def test_a_third_of_all_ids_is_null_or_the_same(spark, hot):
    rows = [(hot if i % 3 == 0 else i, f"text number {i} of this table " * (1 + i % 4), "en", "s") for i in range(3000)]
    docs = docs_of(spark, rows)
    dealt = syncmers.with_successor(docs, parts=8)
    from pyspark.sql import functions as F

    sizes = [r["n"] for r in dealt.filter("NOT halo").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 2 * 3000 / 8
    assert dealt.filter("halo").count() <= 2 * 8 * syncmers.RANGES  # one a range, or a slice of one
    # by falling id, equal ids by the hash of the text, null last
    hashes = {t: h for t, h in docs.select("text", F.xxhash64("text")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    want = []
    for j, (i, t, *_) in enumerate(order):
        following, m = order[(j + 1) % len(order)][1], len(t) // 3
        want.append((i, len(t), hashlib.sha256((t[: len(t) - m] + following[:m]).encode()).hexdigest()))
    got = syncmers.edited_digest(docs, parts=8).select("doc_id", "n_chars", "edited_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
