"""Small inputs and brute-force versions for the tests of strata.llm."""

from __future__ import annotations

import os
import re

import duckdb

SF_TINY = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"
WORDS = re.compile("[^\x20\x09-\x0d]+")

#: Columns with names that the operators use inside, or return.
CLASHES = ["fp", "component_id", "t", "key", "keep", "rk", "place", "size", "p", "bucket", "w", "state", "z"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def docs_of(spark, rows):
    """Rows of (doc_id, text, lang, source) as documents with clashing columns."""
    full = [(i, t, la, s, None if t is None else len(t), *["x"] * len(CLASHES)) for i, t, la, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def edge_rows():
    """Nulls in every column, empty and blank texts, repeated rows, a repeated
    id with another text, equal texts, one very long text."""
    line = "The same long line stands in many of these documents, word for word."
    rows = [(i, f"{line}\nOnly document {i} has this other line of enough length {i}.", "en", f"s{i % 3}") for i in range(1, 8)]
    rows += [
        (None, None, None, None),
        (None, line, "en", None),
        (8, "", "en", "s0"),
        (9, None, None, "s1"),
        (10, " \t\n\x0b\x0c\r ", "de", "s1"),
        (11, "12345 67890 !!", "fr", None),
        (12, line, "en", "s2"),
        (12, line, "en", "s2"),
        (12, "another text under the same id", None, ""),
        (13, line.upper() + "  ", "en", ""),
        (14, " ".join(f"w{i * i % 977}" for i in range(30000)), "en", "s0"),
        (15, "é" * 45 + "\n" + "ü" * 39, "fr", "s0"),
    ]
    return rows


def words_of(text):
    return WORDS.findall(text or "")


def tables(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def groups(n, links):
    """Smallest index reachable, by plain union-find."""
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]
