from __future__ import annotations

from collections import Counter

import pytest

from strata.llm import mixing

from .helpers import SF_TINY, docs_of, edge_rows, words_of


def brute_targets(sizes, weights, share=1.5, epochs=2):
    """Share by weight; clamp; reshare what is left among the rest; again."""
    left, open_, out = share * sum(sizes.values()), dict(weights), {}
    while open_:
        total = sum(open_.values())
        over = [s for s, w in open_.items() if left * w / total >= epochs * sizes[s]]
        if not over:
            return out | {s: left * w / total for s, w in open_.items()}
        for s in over:
            out[s] = epochs * sizes[s]
            del open_[s]
        left -= sum(epochs * sizes[s] for s in over)
    return out


def weights_of(sources):
    order = sorted((s for s in sources if s is not None), key=str.encode) + [None] * (None in sources)
    return {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}


@pytest.mark.parametrize("which", ["edge", "tiny"])
def test_contract(spark, which):
    if which == "edge":
        docs = docs_of(spark, edge_rows())
    else:
        docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(words_of(r["text"]))
    want = brute_targets(sizes, weights_of(set(sizes)))
    got = mixing.mix(docs).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((r["doc_id"], r["source"], len(words_of(r["text"]))) for r in rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert 0 <= want[s] - taken[s] < 1 + 1e-6  # to the word
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)


@pytest.mark.parametrize("kind", ["null ids", "one id", "equal rows"])
def test_hot_ids_meet_the_target_with_one_cut(spark, kind):
    """1000 rows that share an id, or are the same row, in two sources."""
    text = lambda i: " ".join(["same", "words"] * 5 if kind == "equal rows" else [f"w{i}", *["x"] * (i % 19)])
    rows = [(None if kind == "null ids" else 5, text(i), "en", "ab"[i % 2]) for i in range(1000)]
    docs = docs_of(spark, rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words_of(t))
    want = brute_targets(sizes, weights_of(set(sizes)))
    got = mixing.mix(docs).collect()
    out = mixing.mixed_documents(docs).collect()
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert len(mine) == 500
        assert 0 <= want[s] - sum(r["taken"] for r in mine) < 1 + 1e-6
        assert sum(r["size"] > 0 and r["taken"] % r["size"] != 0 for r in mine) <= 1
        assert sum(len(words_of(r["text"])) for r in out if r["source"] == s) == sum(r["taken"] for r in mine)
    whole = {t for _, t, _, _ in rows}
    assert sum(r["text"] not in whole for r in out) <= 2


def test_columns_in_the_way_raise(spark):
    with pytest.raises(ValueError, match="_llm_"):
        mixing.mixed_documents(docs_of(spark, edge_rows()).withColumnRenamed("w", "_llm_size"))


def test_weights_and_clamps(spark):
    sources = spark.createDataFrame([("a", 100, 1), ("b", 10, 8), ("c", 50, 1), ("d", 0, 3), ("e", 40, 0)], "source string, source_size long, weight long")
    got = {r["source"]: r["target"] for r in mixing.water_fill(sources).collect()}
    # 300 words; b is clamped at 20, c at 100, then a takes the rest
    assert got == {"a": 180.0, "b": 20.0, "c": 100.0, "d": 0.0, "e": 0.0}
    got = {r["source"]: r["target"] for r in mixing.water_fill(sources, share=9.0).collect()}
    assert got == {"a": 200.0, "b": 20.0, "c": 100.0, "d": 0.0, "e": 0.0}


def test_ranks_over_partitions(spark):
    names = [f"s{i:03d}" for i in range(200)] + [None]
    sources = spark.createDataFrame([(n,) for n in reversed(names)], "source string").repartition(7)
    from pyspark.sql import functions as F

    got = {r["source"]: r["rank"] for r in mixing.ranked(sources, [F.col("source").asc_nulls_last()], "ranks").collect()}
    assert got == {n: i for i, n in enumerate(names)}


def test_mixed_documents(spark):
    rows = [*edge_rows(), (16, "  lead one\ttwo\n three  ", "en", "s1")]
    docs = docs_of(spark, rows)
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[(r["doc_id"], r["source"], r["place"], r["size"])] += r["taken"]
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    have = Counter((r["doc_id"], r["source"], r["text"]) for r in out.collect())
    texts = {(r["doc_id"], r["source"], r["p"]): r["text"] for r in docs.select("doc_id", "source", "text", mixing.draw().alias("p")).collect()}
    want = Counter()
    for (i, s, place, size), n in taken.items():  # equal rows give their whole repetitions and one part together
        if n:
            t = texts[(i, s, place)]
            want[(i, s, t)] += n // size
            if n % size:
                last = 0
                for w in words_of(t)[: n % size]:
                    last = t.index(w, last) + len(w)
                want[(i, s, t[:last])] += 1
    assert +have == +want
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
