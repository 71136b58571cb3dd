from __future__ import annotations

import hashlib
from collections import defaultdict

from strata.llm import line_dedup

from .helpers import docs_of, edge_rows

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows):
    """Rows of (doc_id, text); the rows of one id are one document."""
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = []
        for line in lines:
            who = holders.get(key(line), ())
            first = max((x for x in who if x is not None), default=None)
            if len(who) < 5 or i == first:
                stay.append(line)
        out.append((i, t, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def test_edge_rows(spark):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    got = sorted(map(tuple, line_dedup.dedup_digest(docs_of(spark, edge_rows())).drop("keep").collect()), key=str)
    want = [(i, n, d, hashlib.sha256(kept.encode()).hexdigest()) for i, _, n, d, kept in brute(rows)]
    assert got == sorted(want, key=str)
    assert any(d for _, _, d, _ in want)


def test_documents_keep_columns_and_nulls(spark):
    docs = docs_of(spark, edge_rows())
    out = line_dedup.dedup_documents(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    want = sorted(((i, t if not d else kept) for i, t, _, d, kept in brute([(i, t) for i, t, *_ in edge_rows()])), key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == want


def test_a_line_in_many_documents_over_many_batches(spark):
    line = "this very line is in a third of all of the documents of the table"
    rows = [(i, f"{line}\nown line number {i} that nobody else has, long enough" if i % 3 == 0 else f"text {i}", "en", "s") for i in range(900)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_digest(docs_of(spark, rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {i: int(i % 3 == 0 and i != 897) for i in range(900)}


def test_bitmap_round_trip(spark):
    rows = edge_rows()
    out = line_dedup.dedup_digest(docs_of(spark, rows)).collect()
    texts = defaultdict(set)
    for i, t, *_ in rows:
        texts[i].add(t or "")
    for r in out:
        assert r["kept_sha256"] in {hashlib.sha256(line_dedup.kept_lines(t.encode(), r["keep"])[0]).hexdigest() for t in texts[r["doc_id"]]}
