from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import token_files

from .helpers import SF_TINY, docs_of, edge_rows

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def rules(path):
    with open(path, encoding="utf-8") as f:
        return f.read()


def brute(docs, path, end):
    """(doc_id, text) to (doc_id, start, ids), by id; rows of one id in any order of theirs."""
    tok = Tokenizer.from_file(path)
    out, start = [], 0
    for i, t in docs:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, *([] if end is None else [end])]
        out.append((i, start, ids))
        start += len(ids)
    return out


def test_query_of_the_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    token_files.write(docs, str(tmp_path / "t"), BYTES)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    want = [(i, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, s, x in brute(rows, BYTES, 2)]
    assert sorted(map(tuple, token_files.read_digest(spark, str(tmp_path / "t")).collect())) == want
    assert token_files.manifest_of(str(tmp_path / "t"))["dtype"] == "<u2"


@pytest.mark.parametrize(("path", "end"), [(BYTES, 2), (WORDS, None), (BYTES, 70_000)])
def test_edge_rows_round_trip(spark, tmp_path, path, end):
    folder = str(tmp_path / "t")
    manifest = token_files.write(docs_of(spark, edge_rows()), folder, path, end_id=end)
    assert manifest["dtype"] == ("<u4" if end == 70_000 else "<u2")
    got = sorted(token_files.read(spark, folder).collect(), key=lambda r: (r["start"], r["n_tokens"]))
    rows = [(i, t) for i, t, *_ in edge_rows()]
    plain = {(i, tuple(x)) for i, _, x in brute(rows, path, end)}
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))  # null first
    assert all((r["doc_id"], tuple(r["ids"])) in plain for r in got) and len(got) == len(rows)
    starts = np.cumsum([0] + [r["n_tokens"] for r in got])
    assert [r["start"] for r in got] == starts[:-1].tolist()
    assert all(len(r["ids"]) == r["n_tokens"] for r in got)
    for k, r in enumerate(got):
        assert token_files.document(folder, k).tolist() == r["ids"]
    with pytest.raises(IndexError):
        token_files.document(folder, len(got))


def test_files_are_flat_and_hold_nothing_but_ids(spark, tmp_path):
    folder = tmp_path / "t"
    manifest = token_files.write(docs_of(spark, [(i, f"text {i}", "en", "s") for i in range(50)]), str(folder), BYTES)
    ids = np.concatenate([np.fromfile(folder / f"{p['name']}.ids", "<u2") for p in manifest["parts"]])
    want = [x for i in range(50) for x in [*Tokenizer.from_file(BYTES).encode(f"text {i}").ids, 2]]
    assert ids.tolist() == want
    assert sum(p["n_docs"] for p in manifest["parts"]) == 50
    for p in manifest["parts"]:
        off = np.fromfile(folder / f"{p['name']}.off", "<i8")
        assert off[0] == 0 and off[-1] == p["n_ids"] and len(off) == p["n_docs"] + 1


def test_empty_table(spark, tmp_path):
    token_files.write(docs_of(spark, []), str(tmp_path / "t"), BYTES)
    assert token_files.read(spark, str(tmp_path / "t")).collect() == []


def test_pieces_give_the_ids_of_whole_texts():
    assert token_files.is_byte_level(rules(BYTES)) and not token_files.is_byte_level(rules(WORDS))
    encode, tok = token_files.encoder(rules(BYTES), "<u2"), Tokenizer.from_file(BYTES)
    rng = random.Random(5)
    letters = [*" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　abcdsStTrevlmd'’.,;:!?\"()-_<|>$%&*#+=/", "é", "ß", "ª", "º", "µ", "÷", "×", "½", "²", "0", "9"]
    letters += ["٣", "ā", "ж", "漢", "́", "‍", "👍", "'s", "'ll", "  ", "\n\n", "<|endoftext|>", "don't", " a", "Ⅷ", "\U0001d7d8"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(16))) for _ in range(20_000)]
    assert encode(texts) == [np.array(e.ids, "<u2").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "PIECES", 10)
    encode, tok = token_files.encoder(rules(BYTES), "<u2"), Tokenizer.from_file(BYTES)
    for k in range(30):
        text = f"some text {k}x{k} with words{k}"
        assert encode([text]) == [np.array(tok.encode(text).ids, "<u2").tobytes()]
