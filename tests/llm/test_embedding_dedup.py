from __future__ import annotations

import math

import numpy as np
import pytest

from strata.llm import embedding_dedup as ed

from .helpers import SF_TINY, groups


def brute(rows, least=0.93):
    """Rows of (vec_id, embedding, label)."""
    unit = []
    for _, v, label in rows:
        bad = label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v)
        unit.append(None if bad else np.array(v, float) / np.linalg.norm(np.array(v, float)))
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= least
    ]
    n = [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    of = groups(len(rows), links)
    least_id = {}
    for (i, *_), g in zip(rows, of, strict=True):
        if i is not None:
            least_id[g] = min(i, least_id.get(g, i))
    return sorted(((r[0], k, least_id.get(g), r[0] is not None and least_id.get(g) == r[0]) for r, k, g in zip(rows, n, of, strict=True)), key=str)


def result(df, **options):
    return sorted(map(tuple, ed.near_duplicates(df, **options).collect()), key=str)


def near_vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 6, dim))
    x = base[rng.integers(len(base), size=n)] + rng.normal(size=(n, dim)) * rng.uniform(0.05, 0.6, (n, 1))
    return [(i, x[i].tolist(), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("leaf, block", [(32, 4096), (64, 8)])
def test_recall_and_counts_against_brute_force(spark, leaf, block):
    rows = near_vectors(600, 24, 2)
    got = result(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), leaf=leaf, block=block)
    want = brute(rows)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found <= true and found >= 0.99 * true and true > 300
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))


def test_links_inside_a_crowd_are_whole_at_depth_nine(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=64)
    crowd = centre / np.linalg.norm(centre) * 0.94**0.5 + rng.normal(size=(1000, 64)) * (0.06 / 64) ** 0.5
    x = np.concatenate((crowd, rng.normal(size=(2000, 64))))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = result(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), leaf=6, block=256)
    want = brute(rows)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.999 * true <= found <= true and true > 500000
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))


def test_one_leaf_is_exact(spark):
    rows = near_vectors(200, 8, 3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(df, leaf=4096) == brute(rows)


def test_table_of_the_driver(spark):
    df = spark.read.parquet(f"{SF_TINY}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert result(df) == brute(rows)


def test_edge_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0), (2, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [], 0), (8, [0.0, -0.0, 0.0], 0),
        (9, [1.0, None, 3.0], 0), (10, [float("nan"), 1.0, 1.0], 0), (11, [float("inf"), 1.0, 1.0], 0), (None, v, 0), (None, [3.0, -1.0, 0.0], 0),
        (12, [1.0, 2.0], 0), (13, [1.0, 2.1], 0), (14, [-1.0, -2.0, -3.0], 0), (15, [0.0, 1.0, 0.0], 2), (16, [-0.0, 1.0, 0.0], 2),
    ]
    df = spark.createDataFrame([(*r, "x", "y", 5) for r in rows], "vec_id long, embedding array<double>, label int, k string, leaf string, n int")
    assert result(df) == brute(rows)


def test_sql_of_the_contract(spark):
    import duckdb

    rows = near_vectors(300, 12, 9) + [(900, None, 0), (901, [0.0] * 12, 0), (902, [1.0] * 12, None), (903, [float("nan")] * 12, 0), (None, [1.0] * 12, 0)]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    got = con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({ed.SQL})").fetchall()
    assert sorted(got, key=str) == brute(rows)
    assert result(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")) == brute(rows)


def test_a_label_that_is_not_split_goes_through_one_tree():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = ed.Forest(x, 4, 10, 0.2, 1, (2 - 2 * 0.93) ** 0.5)
    row, node = forest.leaves(x, np.where(np.arange(3000) % 2, 0, 3))
    copies = np.bincount(row)
    assert (copies[1::2] == 1).all() and (node[row % 2 == 1] == 1).all()
    assert (copies[::2] >= 4).all()


def test_registered_parameters_on_a_hundred_thousand_vectors(spark):
    """Planted pairs at the threshold, a crowd of near copies and exact copies
    among strangers; most rows have one label, which the trees split eight times."""
    rng = np.random.default_rng(7)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    dim, strangers, pairs, crowd = 64, 92_000, 4_000, 4_000
    base = unit(rng.normal(size=(strangers, dim)))
    cosine = rng.uniform(0.93, 0.96, (pairs, 1))
    aside = rng.normal(size=(pairs, dim))
    aside = unit(aside - (aside * base[:pairs]).sum(axis=1, keepdims=True) * base[:pairs])
    near = base[:pairs] * cosine + aside * np.sqrt(1 - cosine**2)
    centre = unit(rng.normal(size=dim))
    noise = rng.normal(size=(crowd, dim)) * (0.055 / dim) ** 0.5
    x = np.concatenate((base, near, unit(centre * 0.945**0.5 + noise), base[-500:]))
    label = np.where(rng.random(len(x)) < 0.9, 0, 1)
    label[strangers : strangers + pairs] = label[:pairs]
    label[strangers + pairs : strangers + pairs + crowd] = 0
    label[-500:] = label[strangers - 500 : strangers]
    df = spark.createDataFrame([(i, v.tolist(), int(la)) for i, (v, la) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in df.transform(ed.near_duplicates).collect()}
    true = found = 0
    for at in range(0, len(x), 4000):
        rows = np.arange(at, min(at + 4000, len(x)))
        links = ((x[rows] @ x.T >= 0.93) & (label[rows][:, None] == label[None, :])).sum(axis=1) - 1
        mine = np.array([got[i] for i in rows.tolist()])
        assert (mine <= links + 1).all()  # the last bit of a cosine may differ here
        true, found = true + links.sum(), found + mine.sum()
    planted = np.array([got[i] for i in range(strangers, strangers + pairs)])
    assert (planted >= 1).mean() > 0.99 and found >= 0.99 * true and true > 1_000_000
