"""Language identification by a byte convolutional network.

Byte embeddings go through filters of several widths, each filter's maximum
over a window of fixed length feeds a softmax over the languages. The network
is trained in numpy on labelled text. A text is cut into windows that cover
all of it; the log-probabilities of its windows are averaged, weighted by
their bytes.

For a filter that rejects text in no language (:func:`accepted`), the network
has one more class, noise: windows made from the labelled ones by shuffling
their bytes, and random ones. :func:`identify` has languages only.

A filter of even width is a sum of lookups by pairs of bytes, so applying the
network takes one table lookup for two bytes of each filter width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows, text_bytes

WIDTHS = (2, 4, 6)
FILTERS = 16
EMBED = 8
WINDOW = 256
#: The training sample: at most so many documents of a language, and windows of each.
FIT_DOCS = 1500
FIT_WINDOWS = 4
UNDETERMINED = "und"
LETTER = r"\p{L}"


@dataclass
class ByteCnn:
    langs: list[str]
    embed: np.ndarray  # (256, EMBED)
    filters: list[np.ndarray]  # one for each width: (width, EMBED, FILTERS)
    bias: np.ndarray  # (len(WIDTHS) * FILTERS,)
    out: np.ndarray  # (features, langs)
    out_bias: np.ndarray

    def pair_tables(self) -> list[list[np.ndarray]]:
        """For each width, width / 2 tables of (65536, FILTERS): the share of the
        first, second, ... pair of bytes. A pair's index is its little-endian value."""
        tables = []
        for w in self.filters:
            one = [(self.embed @ w[j]).astype(np.float32) for j in range(w.shape[0])]
            tables.append([(one[j + 1][:, None, :] + one[j][None, :, :]).reshape(65536, -1) for j in range(0, w.shape[0], 2)])
        return tables

    def features(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """(n, features) of (n, WINDOW) bytes."""
        pairs = windows[:, :-1].astype(np.uint16) | (windows[:, 1:].astype(np.uint16) << np.uint16(8))
        pooled = []
        for parts in tables:
            steps = pairs.shape[1] - 2 * (len(parts) - 1)
            y = parts[0][pairs[:, :steps]]
            for j, t in enumerate(parts[1:], 1):
                y += t[pairs[:, 2 * j : 2 * j + steps]]
            pooled.append(y.max(axis=1))
        return np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)

    def log_probs(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        z = self.features(windows, tables) @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def cut(text: bytes, window: int = WINDOW) -> np.ndarray:
    """(n, window) bytes that cover all of the text, filled up with blanks."""
    n = max(1, -(-len(text) // window))
    return np.frombuffer(text.ljust(n * window), np.uint8).reshape(n, window)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = 6, batch: int = 64, seed: int = 7) -> ByteCnn:
    """Adam on softmax cross-entropy; gradients flow through the maxima only."""
    rng = np.random.default_rng(seed)
    k = len(langs)
    p = {"e": rng.normal(0, 0.5, (256, EMBED)), "b": np.zeros(len(WIDTHS) * FILTERS), "o": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, k)), "c": np.zeros(k)}
    p |= {f"w{w}": rng.normal(0, (EMBED * w) ** -0.5, (w, EMBED, FILTERS)) for w in WIDTHS}
    p = {n: v.astype(np.float32) for n, v in p.items()}
    m = {n: np.zeros_like(v) for n, v in p.items()}
    s = {n: np.zeros_like(v) for n, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            x, y = windows[order[at : at + batch]], labels[order[at : at + batch]]
            n = len(x)
            emb = p["e"][x]  # (n, WINDOW, EMBED)
            pooled, best = [], []
            for w in WIDTHS:
                steps = x.shape[1] - w + 1
                conv = sum(emb[:, j : j + steps] @ p[f"w{w}"][j] for j in range(w))
                t = conv.argmax(axis=1)  # (n, FILTERS)
                best.append(t)
                pooled.append(np.take_along_axis(conv, t[:, None, :], 1)[:, 0])
            pre = np.concatenate(pooled, axis=1) + p["b"]
            h = np.maximum(pre, 0)
            z = h @ p["o"] + p["c"]
            z -= z.max(axis=1, keepdims=True)
            prob = np.exp(z)
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(n), y] -= 1
            dz = prob / n
            dh = (dz @ p["o"].T) * (pre > 0)
            g = {"o": h.T @ dz, "c": dz.sum(axis=0), "b": dh.sum(axis=0), "e": np.zeros_like(p["e"])}
            rows = np.arange(n)[:, None]
            for i, w in enumerate(WIDTHS):
                d = dh[:, i * FILTERS : (i + 1) * FILTERS]
                g[f"w{w}"] = np.zeros_like(p[f"w{w}"])
                for j in range(w):
                    at_byte = x[rows, best[i] + j]  # (n, FILTERS)
                    g[f"w{w}"][j] = np.einsum("nfe,nf->ef", p["e"][at_byte], d)
                    np.add.at(g["e"], at_byte, d[:, :, None] * p[f"w{w}"][j].T[None])
            step += 1
            for name, v in g.items():
                m[name] = 0.9 * m[name] + 0.1 * v
                s[name] = 0.99 * s[name] + 0.01 * v * v
                p[name] -= (0.01 * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return ByteCnn(langs, p["e"], [p[f"w{w}"] for w in WIDTHS], p["b"], p["o"], p["c"])


def held_out(id_col: str = "doc_id"):
    """Documents never learned from. A null id is not held out, and not learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def noise_windows(windows: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """(n, WINDOW) bytes in no language. Half are labelled windows with their
    bytes shuffled, so that the frequencies of letters tell nothing; the rest
    are runs of random letters and digits, of any printable ASCII, and of random
    two-byte letters."""
    rng = np.random.default_rng(seed)
    kinds = np.array_split(np.arange(n), [n // 2, n * 5 // 8, n * 3 // 4])
    out = np.zeros((n, windows.shape[1]), np.uint8)
    out[kinds[0]] = rng.permuted(windows[rng.integers(0, len(windows), len(kinds[0]))], axis=1)
    signs = np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789        ", np.uint8)
    out[kinds[1]] = signs[rng.integers(0, len(signs), out[kinds[1]].shape)]
    out[kinds[2]] = rng.integers(32, 127, out[kinds[2]].shape)
    out[kinds[3]] = np.where(np.arange(windows.shape[1]) % 2 == 0, rng.integers(0xC3, 0xDF, out[kinds[3]].shape), rng.integers(0x80, 0xC0, out[kinds[3]].shape))
    return out


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_lang: int = FIT_DOCS, windows: int = FIT_WINDOWS, noise: bool = False,
) -> ByteCnn | None:
    """Train on a bounded sample: about ``per_lang`` documents of each language,
    chosen by a hash of the id, and ``windows`` windows of each, spread over its
    whole text. With ``noise``, ``und`` is one more class, of as many windows as
    a language has on average. None if nothing is labelled."""
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).rlike(LETTER) & ~held_out(id_col))
    usable = usable.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    draw = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_lang / n))])
    sample = usable.filter(draw < share[F.col("lang")]).withColumn("draw", draw)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple[int, str, bytes]] = []
        for i, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            x = cut(text)
            out += [(i, lang, x[j].tobytes()) for j in sorted({len(x) * k // windows for k in range(windows)})]
        ids, langs, parts = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs), pa.array(parts, pa.binary())], ["id", "lang", "w"])

    rows = map_rows(sample.select("id", "lang", text_bytes("text")), run, "id long, lang string, w binary")
    limit = 2 * per_lang * windows * len(counts)  # a bound that the sample's size does not reach by chance
    got = sorted({(r["id"], r["lang"], bytes(r["w"])) for r in rows.orderBy(F.xxhash64("id"), "id", "w").limit(limit).collect()})
    langs = sorted({g[1] for g in got})
    at = {lang: i for i, lang in enumerate(langs)}
    x = np.frombuffer(b"".join(g[2] for g in got), np.uint8).reshape(-1, WINDOW)
    y = np.array([at[g[1]] for g in got])
    if noise:
        made = noise_windows(x, max(8, len(x) // len(langs)))
        x, y, langs = np.concatenate((x, made)), np.concatenate((y, np.full(len(made), len(langs)))), [*langs, UNDETERMINED]
    steps = max(1, len(x) // 64)
    return train(x, y, langs, epochs=int(min(30, max(2, -(-1500 // steps)))))


def prediction(model: ByteCnn | None, text_col: str = "text") -> Column:
    """A column ``struct<lang, score>``: (``und``, 0) if the text is null or has
    no letter, or if there is no model."""
    block = 64  # windows in a product: its arrays stay in the cache

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tables = model.pair_tables() if model else []  # the model itself is a few thousand numbers
        for letters, texts in batches:
            langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            rows = np.flatnonzero(letters.to_numpy(zero_copy_only=False) & (model is not None))
            for some in _chunks(rows, texts):
                parts = [cut(t) for _, t in some]
                sizes = [len(t) for _, t in some]
                x = np.concatenate(parts)
                logs = np.concatenate([model.log_probs(x[a : a + block], tables) for a in range(0, len(x), block)])
                weight = np.concatenate([_window_bytes(s) for s in sizes])
                starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
                mean = np.add.reduceat(logs * weight[:, None], starts, axis=0) / np.array(sizes)[:, None]
                prob = np.exp(mean - mean.max(axis=1, keepdims=True))
                prob /= prob.sum(axis=1, keepdims=True)
                for (i, _), q in zip(some, prob, strict=True):
                    langs[i], scores[i] = model.langs[int(q.argmax())], float(q.max())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    letters = F.coalesce(F.col(text_col).rlike(LETTER), F.lit(False))
    return F.arrow_udf(run, "lang string, score double")(letters, text_bytes(text_col))


def predict(docs: DataFrame, model: ByteCnn | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row.

    Only the text is an input of a prediction. Repeated rows stay repeated; a
    null id is kept, not held out. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), prediction(model, text_col).alias("p")
    )
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def _window_bytes(size: int) -> np.ndarray:
    n = -(-size // WINDOW)
    out = np.full(n, WINDOW, np.float64)
    out[-1] = size - WINDOW * (n - 1)
    return out


def _chunks(rows: np.ndarray, texts: pa.Array, most: int = 1 << 20) -> Iterator[list[tuple[int, bytes]]]:
    """Rows with their texts, about ``most`` bytes at a time."""
    some: list[tuple[int, bytes]] = []
    size = 0
    for i in rows.tolist():
        t = texts[i].as_py()
        some.append((i, t))
        size += len(t)
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Fit on the labelled documents that are not held out, predict all."""
    return predict(docs, fit(docs, id_col, text_col, lang_col), id_col, text_col)


def accepted(docs: DataFrame, least_score: float = 0.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all their columns, that are text in one of the
    languages: not likelier noise than any language, and at least ``least_score``
    likely. Rows without letters have no language and go. Without any label
    there is no language to know, and all rows go."""
    if "_llm_language" in docs.columns:
        raise ValueError("a column _llm_language is used inside")
    model = fit(docs, id_col, text_col, lang_col, noise=True)
    found = docs.withColumn("_llm_language", prediction(model, text_col))
    return found.filter((F.col("_llm_language.lang") != UNDETERMINED) & (F.col("_llm_language.score") >= least_score)).select(*docs.columns)
