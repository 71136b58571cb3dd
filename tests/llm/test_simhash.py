from __future__ import annotations

import numpy as np
import pytest
import xxhash

from strata.llm import simhash
from strata.llm.common import connected_components

from .helpers import SF_TINY, docs_of, edge_rows, groups, words_of


def brute_fingerprint(text, shingle=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = words_of(low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    prints = [brute_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    of = groups(len(rows), links)
    least = {}
    for (i, _), g in zip(rows, of, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, of, strict=True)), key=str)


def result(docs, **options):
    got = simhash.near_duplicates(docs, **options)
    return sorted(map(tuple, got.select("doc_id", simhash.hex_fingerprint(), "component_id").collect()), key=str)


def test_matches_brute_force_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    assert result(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edge_rows(spark):
    rows = edge_rows()
    assert result(docs_of(spark, rows)) == brute([(i, t) for i, t, *_ in rows])


def near_prints(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    out = set()
    while len(out) < n:
        v = int(base[rng.integers(6)])
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            v ^= 1 << int(bit)
        out.add(v)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_comparison(radius):
    v = near_prints(300, radius)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= radius
    want = {(i, j) for i, j in zip(*np.nonzero(near), strict=True) if i < j}
    group = np.zeros(len(v), np.int64)
    a, b = simhash.adjacent_links(v, group, radius)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want
    pairs = {(i, j) for x, y in simhash.cross_links(v, v, radius, True) for i, j in zip(x.tolist(), y.tolist(), strict=True)}
    assert pairs == want
    half = {(i, j - 100) for i, j in want if i < 100 <= j}
    got = {(i, j) for x, y in simhash.cross_links(v[:100], v[100:], radius, False) for i, j in zip(x.tolist(), y.tolist(), strict=True)}
    assert got == half


@pytest.mark.parametrize("block", [16, 8192])
def test_buckets_cut_into_blocks_lose_no_link(spark, block):
    v = near_prints(400, 9)
    fps = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    got = {r["node"]: r["component"] for r in connected_components(simhash.fingerprint_links(fps, 2, block)).collect()}
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 2
    of = groups(len(v), zip(*np.nonzero(near), strict=True))
    signed = v.view(np.int64).tolist()
    assert same_groups([got.get(x, x) for x in signed], of)


def same_groups(a, b):
    """Two namings of groups that split the same rows in the same way."""
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


def test_components_of_a_path_and_of_stars(spark):
    rng = np.random.default_rng(1)
    order = rng.permutation(60).tolist()
    edges = list(zip(order[:39], order[1:40], strict=True)) + [(100, x) for x in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert set(got) == {*order[:40], *range(100, 130)}
    assert len({got[x] for x in order[:40]}) == len({got[x] for x in range(100, 130)}) == 1
    assert got[order[0]] in order[:40] and got[100] >= 100
    assert connected_components(spark.createDataFrame([(1, 1)], "src long, dst long")).count() == 0


@pytest.mark.parametrize("kind", ["path", "random", "rings"])
def test_components_against_union_find(spark, kind):
    rng = np.random.default_rng(3)
    n = 300
    edges = {
        "path": [(i, i + 1) for i in range(n - 1)],
        "random": [tuple(x) for x in rng.integers(0, n, (200, 2)).tolist()],
        "rings": [(i, i // 10 * 10 + (i + 1) % 10) for i in range(n)],
    }[kind]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert same_groups([got.get(i, i) for i in range(n)], groups(n, edges))


def test_one_row_of_each_group_stays(spark):
    rows = [*edge_rows(), (20, "a b c d e", "en", "s"), (19, "A b  c d E", "en", "s"), (19, "A b  c d E", "en", "s")]
    docs = docs_of(spark, rows)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    of = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    assert len(got) == len(set(of))
    assert (19, "A b  c d E") in got and not any(i == 20 for i, _ in got)
    for g in set(of):
        ids = [rows[i][0] for i in range(len(rows)) if of[i] == g]
        known = [i for i in ids if i is not None]
        assert any(i == (min(known) if known else None) for i, _ in got)
