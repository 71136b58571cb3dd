from __future__ import annotations

import zlib

from strata.llm import language

from .helpers import SF_SMALL, docs_of, edge_rows


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_prediction_reads_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = language.fit(docs)
    some = docs.limit(50)
    changed = some.selectExpr("doc_id + 1000000 AS doc_id", "text", "'zz' AS lang", "'other' AS source")
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(some, model).collect()}
    b = {r["doc_id"] - 1000000: (r["lang_pred"], r["score"]) for r in language.predict(changed, model).collect()}
    assert a == b


def test_windows_cover_the_whole_text():
    for n in (0, 1, 255, 256, 257, 5000):
        text = bytes(i % 251 + 1 for i in range(n))
        assert language.cut(text).tobytes()[:n] == text
        if n:
            assert language._window_bytes(n).sum() == n


def test_edge_rows(spark):
    rows = edge_rows()
    found = language.identify(docs_of(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] not in (None, 12)}
    for i in (8, 9, 10, 11):  # empty, null, blank, digits only
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert all(r["lang_pred"] in ("en", "fr") for i, r in by_id.items() if i not in (8, 9, 10, 11))
    assert all(not r["held_out"] for r in found if r["doc_id"] is None)


def test_no_label_means_undetermined(spark):
    docs = docs_of(spark, [(1, "some text", None, "s"), (2, "more text", None, "s")])
    assert {r["lang_pred"] for r in language.identify(docs).collect()} == {"und"}


def test_accepted_keeps_columns(spark):
    docs = docs_of(spark, edge_rows())
    out = language.accepted(docs, 0.4)
    assert out.columns == docs.columns
    assert {r["doc_id"] for r in out.collect()} >= {1, 2, 3, 4, 5, 6, 7, 12, 14}
    assert not {8, 9, 10, 11} & {r["doc_id"] for r in out.collect()}


def test_noise_goes_and_clean_held_out_documents_stay(spark):
    import random

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rng = random.Random(8)
    signs = "abcdefghijklmnopqrstuvwxyz0123456789"
    soup = lambda n: " ".join("".join(rng.choices(signs, k=rng.randrange(2, 12))) for _ in range(n))
    shuffled = ["".join(rng.sample(r["text"], len(r["text"]))) for r in docs.filter("length(text) BETWEEN 300 AND 3000").limit(40).collect()]
    noise = [soup(rng.randrange(40, 400)) for _ in range(40)] + shuffled
    noise += ["".join(chr(rng.randrange(0x400, 0x460)) for _ in range(600)), "0x" + " ".join(f"{rng.randrange(1 << 32):08x}" for _ in range(90))]
    rows = [(10_000_000 + i, t, None, "noise", len(t)) for i, t in enumerate(noise)]
    both = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = {r["doc_id"] for r in language.accepted(both).select("doc_id").collect()}
    assert len([i for i in kept if i >= 10_000_000]) <= 0.05 * len(noise)
    clean = {r["doc_id"] for r in docs.filter("text RLIKE '\\\\p{L}'").filter(language.held_out()).select("doc_id").collect()}
    assert len(clean - kept) <= 0.002 * len(clean)


def test_pair_tables_equal_the_plain_convolution():
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (40, language.WINDOW)).astype(np.uint8)
    model = language.train(x, rng.integers(0, 3, 40), ["a", "b", "c"], epochs=2)
    pooled = []
    for w in model.filters:
        emb = model.embed[x]
        steps = x.shape[1] - len(w) + 1
        pooled.append(sum(emb[:, j : j + steps] @ w[j] for j in range(len(w))).max(axis=1))
    z = np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0) @ model.out + model.out_bias
    want = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    assert np.abs(model.log_probs(x, model.pair_tables()) - want).max() < 1e-5
