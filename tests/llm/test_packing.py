from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import packing

from .helpers import SF_TINY, docs_of, edge_rows, words_of


def naive(sizes, sources, clusters, capacity):
    bins = []
    out = []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(capacity - b["used"], i) for i, b in enumerate(bins) if capacity - b["used"] >= max(size, 1) and s not in b["s"] and (c < 0 or c not in b["c"])]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"used": 0, "s": set(), "c": set()})
        bins[i]["used"] += size
        bins[i]["s"].add(s)
        bins[i]["c"].add(c)
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_equals_a_full_search(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randrange(0, 101) for _ in range(150)), reverse=True)
    sources = [rng.randrange(6) for _ in sizes]
    clusters = [rng.choice([-1, 0, 1, 2]) for _ in sizes]
    assert packing.best_fit(sizes, sources, clusters, 100) == naive(sizes, sources, clusters, 100)


def checked(rows, got, capacity):
    """The rules of the bins, and that each document's pieces make it up."""
    bins = defaultdict(list)
    pieces = defaultdict(int)
    for r in got:
        bins[r["bin_id"]].append(r)
        pieces[r["doc_id"]] += r["size"]
        assert r["start_word"] == r["piece"] * capacity and r["size"] <= capacity
    want = defaultdict(int)
    for i, t, *_ in rows:
        want[i] += len(words_of(t))
    assert pieces == want
    for members in bins.values():
        assert sum(r["size"] for r in members) <= capacity
        assert len({r["source_hash"] for r in members}) == len(members)
        known = [r["cluster"] for r in members if r["cluster"] is not None]
        assert len(set(known)) == len(known)
    return bins


@pytest.mark.parametrize("shard", [16, 4096])
def test_rules_hold_on_the_smallest_table(spark, shard):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    checked(rows, packing.pack(docs, capacity=300, shard=shard).collect(), 300)


def test_edge_rows(spark):
    rows = edge_rows()
    got = packing.pack(docs_of(spark, rows), capacity=2048).collect()
    checked(rows, got, 2048)
    assert len({r["bin_id"] for r in got if r["doc_id"] == 12 and r["n_words"] == 13}) == 2  # repeated rows share no bin


def test_given_clusters(spark):
    docs = docs_of(spark, [(i // 2, f"t {i}", "en", f"s{i}") for i in range(10)])
    got = packing.pack(docs, cluster=F.col("doc_id")).collect()
    assert len({(r["doc_id"], r["bin_id"]) for r in got}) == 10 and len({r["bin_id"] for r in got}) == 2


@pytest.mark.parametrize("shard", [64, 4096])
def test_bins_do_not_depend_on_the_order_of_rows(spark, shard):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.unionByName(docs.limit(30)).unionByName(docs.limit(30))  # equal rows too

    def bins(df):
        out = defaultdict(list)
        for r in packing.pack(df, capacity=1024, shard=shard).collect():
            out[r["bin_id"]].append((r["doc_id"], r["piece"], r["size"], r["source_hash"]))
        return sorted(sorted(x, key=str) for x in out.values())

    want = bins(docs)
    assert bins(docs.repartition(7)) == want
    assert bins(docs.orderBy(F.rand(3)).coalesce(3)) == want


def test_later_rounds_fill_bins(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    n = {}
    for shard in (16, 4096):
        n[shard] = len(checked(rows, packing.pack(docs, shard=shard).collect(), 2048))
    first = packing.FILLED
    try:
        packing.FILLED = -1.0  # no bin is opened again
        alone = len(checked(rows, packing.pack(docs, shard=16).collect(), 2048))
    finally:
        packing.FILLED = first
    assert n[4096] <= n[16] <= (n[4096] + alone) / 2
