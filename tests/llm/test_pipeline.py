"""The pipeline's stages, each against a brute-force version of its own input."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from strata.llm import language
from strata.llm.common import written

from .helpers import SF_TINY, docs_of, edge_rows, groups, words_of
from .test_line_dedup import brute as lines_brute
from .test_packing import checked
from .test_simhash import brute_fingerprint


def steps(spark, docs):
    """(name, input, output) of every stage."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF_TINY), f"test-{name}")
        out.append((name, docs, result))
        docs = result
    return out


def check(spark, docs):
    found = {name: (before, after) for name, before, after in steps(spark, docs)}
    columns = docs.columns
    assert all(after.columns == columns for name, (_, after) in found.items() if name != "best_fit_packing")

    before, after = found["language_id"]
    model = language.fit(before, noise=True)
    texts = Counter(r["doc_id"] for r in language.predict(before, model).filter("lang_pred <> 'und'").collect())
    assert Counter(r["doc_id"] for r in after.collect()) == texts

    before, after = found["line_dedup"]
    want = Counter((i, t if not d else kept) for i, t, _, d, kept in lines_brute([(r["doc_id"], r["text"]) for r in before.collect()]))
    assert Counter((r["doc_id"], r["text"]) for r in after.collect()) == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = found["simhash_near_dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    prints = [brute_fingerprint(t) for _, t in rows]
    of = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    ids = defaultdict(list)
    for (i, _), g in zip(rows, of, strict=True):
        ids[g].append(i)
    first = [min((x for x in members if x is not None), default=None) for members in ids.values()]
    assert Counter(r["doc_id"] for r in after.collect()) == Counter(first)

    before, after = found["source_mixing"]
    size = {r["doc_id"]: len(words_of(r["text"])) for r in before.collect()}
    total = Counter()
    for r in after.collect():
        total[r["doc_id"]] += len(words_of(r["text"]))
    assert all(n <= 2 * size[i] for i, n in total.items())
    assert abs(sum(total.values()) - 1.5 * sum(size.values())) <= len(size) + 3

    before, after = found["best_fit_packing"]
    bins = checked([(r["doc_id"], r["text"]) for r in before.collect()], after.collect(), 2048)
    for members in bins.values():  # no two repetitions of a document
        known = [r["doc_id"] for r in members if r["doc_id"] is not None]
        assert len(set(known)) == len(known)


def test_stages_on_the_smallest_table(spark):
    check(spark, spark.read.parquet(f"{SF_TINY}/documents.parquet"))


def test_stages_on_edge_rows(spark):
    check(spark, docs_of(spark, edge_rows()))


def test_run_is_the_stages_together(spark):
    got = corpus_pipeline.run(spark, SF_TINY)
    assert got.count() > 0 and "bin_id" in got.columns


def test_an_empty_table_runs_through_all_stages(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet").filter("false")
    found = steps(spark, docs)
    assert all(after.count() == 0 for _, _, after in found)
    assert [after.columns == docs.columns for _, _, after in found] == [True] * 4 + [False]
