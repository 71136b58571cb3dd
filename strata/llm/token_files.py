"""Token ids as flat binary files with 64-bit document offsets.

A token folder holds, for each part, three flat little-endian files

    <part>.ids   the ids of its documents, one after another: uint16 if every
                 id fits, else uint32
    <part>.off   int64, where each document's ids begin in the part, and the
                 part's number of ids at the end
    <part>.doc   int64, the documents' ids; those of null id stand first

and ``parts.json``, the manifest: the parts in order, with the numbers of
documents, null ids and token ids of each, and of all parts before it (its
bases, by prefix sums). Documents ascend by id through the parts, so the ids of
document k of a part begin at base + off[k] in the whole and the files can be
memory-mapped by any reader; nothing in a part depends on other parts.

Writing is one shuffle of the texts into ranges of ids; each task encodes its
range as a stream and writes its files under names of its own attempt. Only the
parts that Spark reports as done reach the manifest, so retried, speculative
and lost tasks leave at most files that nobody lists.

Encoding. With a byte-level BPE tokenizer, texts are cut where its pattern
surely cuts as well, and the ids of pieces seen before are looked up; new
pieces go to the tokenizers library. Other tokenizers get whole texts.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from types import ModuleType
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import written

END_ID = 2
#: Bytes of text encoded at a time.
SLICE = 4 << 20
#: Bytes of ids read at a time, and documents in a batch of rows.
READ, DOCS = 8 << 20, 8192
#: Pieces a Python worker remembers before it starts anew.
PIECES = 1_000_000
#: Texts a part holds on average, in bytes.
PART = 512 << 20
#: A tokenizer file goes to the executors with the task's code.
MOST_TOKENIZER = 64 << 20

LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"  # all letters below U+0100
MARKS = r""".,;:!?$%&*#()"+=/-"""
#: 1: a word or a number before a blank, a mark or the end, with the space before it; 2: marks before a
#: blank; 3: one newline before text. Each is one piece of the byte-level pattern. Otherwise: blanks and
#: what follows, up to the next space or newline after a non-blank.
PIECE = re.compile(
    rf" ?[{LETTERS}]+(?=[\s{MARKS}]|\Z)| ?[0-9]+(?=[\s{MARKS}]|\Z)|[{MARKS}]+(?=[ \n]|\Z)|\n(?=\S)|\s*\S+(?:[^\S \n]\s*\S*)*|\s+"
)
ONE = re.compile(rf" ?[{LETTERS}]+| ?[0-9]+|[{MARKS}]+|\n")


def is_byte_level(tokenizer: str) -> bool:
    """Whether a tokenizer (its JSON) is a byte-level BPE whose added tokens hold no blanks and only such
    beginnings and ends as no word or punctuation piece has."""
    t = json.loads(tokenizer)
    pre, model = t.get("pre_tokenizer") or {}, t["model"]
    plain = all(
        not (a["lstrip"] or a["rstrip"] or a["single_word"]) and not re.search(r"\s", a["content"]) and re.fullmatch(r"<\|.*\|>", a["content"])
        for a in t.get("added_tokens") or []
    )
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    whole = not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"))
    return plain and byte_level and whole and model.get("type") == "BPE" and not t.get("normalizer") and not t.get("truncation")


def byte_letters() -> dict[int, str]:
    """How byte-level BPE writes bytes as characters: printable ones as they are, the others from U+0100 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Known(dict):
    """Pieces to their ids as bytes; a new piece is encoded when it is first asked for."""

    def __init__(self, tokenizer, dtype: str):
        self.tokenizer, self.merge, self.dtype = tokenizer, tokenizer.model.tokenize, dtype
        letters = byte_letters()
        self.spelled = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}

    def __missing__(self, piece: str) -> bytes:
        if ONE.fullmatch(piece):
            ids = [x.id for x in self.merge(piece.translate(self.spelled))]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        self[piece] = out = np.array(ids, self.dtype).tobytes()
        return out


def encoder(tokenizer: str, dtype: str) -> Callable[[list[str]], list[bytes]]:
    """Texts to their ids, as little-endian bytes."""
    from tokenizers import Tokenizer

    if not is_byte_level(tokenizer):
        tok = Tokenizer.from_str(tokenizer)
        return lambda texts: [np.array(e.ids, dtype).tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    # Python workers are reused: what one task has looked up serves the next ones of the worker.
    memory = sys.modules.setdefault("strata_worker_memory", ModuleType("strata_worker_memory")).__dict__
    name = f"pieces-{zlib.crc32(tokenizer.encode())}-{dtype}"
    known = memory.get(name)
    if known is None:
        known = memory[name] = Known(Tokenizer.from_str(tokenizer), dtype)

    def by_pieces(texts: list[str]) -> list[bytes]:
        if len(known) > PIECES:
            known.clear()
        return [b"".join(map(known.__getitem__, PIECE.findall(t))) for t in texts]

    return by_pieces


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder and the folder's path there; a path without scheme is local."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path or uri
    return fs.FileSystem.from_uri(uri)


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> dict:
    """Encode every text, write the token folder, return its manifest.

    ``tokenizer`` is the path of a tokenizers JSON file, read once here.
    ``end_id`` is appended to every document (None: nothing is). Strings of
    special tokens in a text become those tokens, as the library has it. A null
    text is empty. Rows that share an id stand in the order of their text's
    hash; null ids stand first. Other columns are not read.
    """
    store, path = filesystem(tokenizer)
    if store.get_file_info(path).size > MOST_TOKENIZER:
        raise ValueError(f"{tokenizer} is larger than {MOST_TOKENIZER} bytes")
    with store.open_input_stream(path) as f:
        rules = f.read().decode()
    from tokenizers import Tokenizer

    vocab = Tokenizer.from_str(rules).get_vocab(with_added_tokens=True)
    dtype = "<u2" if max([*vocab.values(), end_id or 0]) < 1 << 16 else "<u4"
    width, end = int(dtype[-1]), b"" if end_id is None else np.array([end_id], dtype).tobytes()
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("t")]
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if encode is None:
                encode = encoder(rules, dtype)
                part = TaskContext.get().partitionId()
                name = f"{part:06d}-{uuid.uuid4().hex[:12]}"
                out, at = filesystem(folder)
                out.create_dir(at, recursive=True)
                files = {x: out.open_output_stream(f"{at}/{name}.{x}") for x in ("ids", "off", "doc")}
                files["off"].write(np.zeros(1, "<i8").tobytes())
                n_docs = n_null = n_ids = 0
            doc_id, texts = batch.column("doc_id"), batch.column("t")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // SLICE
            cuts = [0, *(np.flatnonzero(sizes[1:] != sizes[:-1]) + 1).tolist(), len(sizes)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                ids = [x + end for x in encode(texts.slice(a, b - a).to_pylist())]
                files["ids"].write(b"".join(ids))
                offsets = n_ids + np.cumsum([len(x) // width for x in ids], dtype="<i8")
                files["off"].write(offsets.tobytes())
                n_ids = int(offsets[-1])
            files["doc"].write(doc_id.fill_null(0).to_numpy().astype("<i8").tobytes())
            n_docs += batch.num_rows
            n_null += doc_id.null_count
        if encode is not None:
            for f in files.values():
                f.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "n_docs": n_docs, "n_null": n_null, "n_ids": n_ids}])

    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    done = written(dealt.mapInArrow(run, "part long, name string, n_docs long, n_null long, n_ids long"), "token-parts")
    listed = [r.asDict() for r in done.orderBy("part").collect()]  # one small row for each part
    for what in ("docs", "ids"):
        bases = np.cumsum([0] + [p[f"n_{what}"] for p in listed], dtype=np.int64).tolist()
        for p, base in zip(listed, bases, strict=False):
            p[f"{what}_before"] = base
    manifest = {"dtype": dtype, "end_id": end_id, "parts": listed}
    out, at = filesystem(folder)
    out.create_dir(at, recursive=True)
    with out.open_output_stream(f"{at}/parts.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def manifest_of(folder: str) -> dict:
    store, at = filesystem(folder)
    with store.open_input_stream(f"{at}/parts.json") as f:
        return json.loads(f.read())


class Part:
    """The files of one part: memory-mapped where they are local, else read by ranges."""

    def __init__(self, folder: str, part: dict, dtype: str):
        self.store, at = filesystem(folder)
        self.path, self.dtype, self.part = f"{at}/{part['name']}", np.dtype(dtype), part
        self.files: dict = {}

    def values(self, kind: str, a: int, b: int) -> np.ndarray:
        """Values ``a`` to ``b`` of the file of this kind."""
        dtype = self.dtype if kind == "ids" else np.dtype("<i8")
        if a >= b:
            return np.zeros(0, dtype)
        if isinstance(self.store, fs.LocalFileSystem):
            if kind not in self.files:
                self.files[kind] = np.memmap(f"{self.path}.{kind}", dtype, "r")
            return self.files[kind][a:b]
        if kind not in self.files:
            self.files[kind] = self.store.open_input_file(f"{self.path}.{kind}")
        return np.frombuffer(self.files[kind].read_at((b - a) * dtype.itemsize, a * dtype.itemsize), dtype)


def parts_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest's parts as rows, one to a partition."""
    manifest = manifest_of(folder)
    names = ["part", "name", "n_docs", "n_null", "n_ids", "docs_before", "ids_before"]
    kinds = ", ".join(f"{c} {'string' if c == 'name' else 'long'}" for c in names)
    rows = spark.createDataFrame([tuple(p[c] for c in names) for p in manifest["parts"]], kinds)
    return rows.repartitionByRange(max(1, len(manifest["parts"])), "part")


def _read(spark: SparkSession, folder: str, fields: str, result: Callable[[list[np.ndarray]], list[pa.Array]], names: list[str]) -> DataFrame:
    dtype = manifest_of(folder)["dtype"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                part = Part(folder, p, dtype)
                for a in range(0, p["n_docs"], DOCS):
                    b = min(a + DOCS, p["n_docs"])
                    off = part.values("off", a, b + 1)
                    # documents whose ids are read together
                    step = np.asarray(off[:-1]) * np.dtype(dtype).itemsize // READ
                    cuts = [0, *(np.flatnonzero(step[1:] != step[:-1]) + 1).tolist(), b - a]
                    for u, v in zip(cuts, cuts[1:], strict=False):
                        ids = part.values("ids", int(off[u]), int(off[v]))
                        at = (np.asarray(off[u : v + 1]) - off[u]).tolist()
                        doc_id = pa.array(np.asarray(part.values("doc", a + u, a + v)), pa.int64(), mask=np.arange(a + u, a + v) < p["n_null"])
                        start = pa.array(p["ids_before"] + np.asarray(off[u:v]), pa.int64())
                        count = pa.array(np.diff(off[u : v + 1]), pa.int64())
                        docs = [ids[x:y] for x, y in zip(at, at[1:], strict=False)]
                        yield pa.RecordBatch.from_arrays([doc_id, start, count, *result(docs)], ["doc_id", "start", "n_tokens", *names])

    return parts_frame(spark, folder).mapInArrow(run, f"doc_id long, start long, n_tokens long, {fields}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document of a token folder, from its files."""
    lists = lambda docs: [pa.array([x.astype(np.int64) for x in docs], pa.list_(pa.int64()))]
    return _read(spark, folder, "ids array<long>", lists, ["ids"])


def read_digest(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files:
    unsigned crc32 of its ids as little-endian unsigned 32-bit integers."""
    sums = lambda docs: [pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in docs], pa.int64())]
    return _read(spark, folder, "ids_crc32 long", sums, ["ids_crc32"])


def document(folder: str, k: int) -> np.ndarray:
    """The ids of document ``k`` (0, 1, ... in the order of the files)."""
    manifest = manifest_of(folder)
    if not 0 <= k < sum(p["n_docs"] for p in manifest["parts"]):
        raise IndexError(k)
    at = np.searchsorted([p["docs_before"] for p in manifest["parts"]], k, side="right") - 1
    p = manifest["parts"][at]
    part = Part(folder, p, manifest["dtype"])
    a, b = part.values("off", k - p["docs_before"], k - p["docs_before"] + 2).tolist()
    return part.values("ids", a, b)
