"""Toxicity by cumulative-link ordinal regression.

P(grade >= j) = sigmoid(w . x - t_j): one weight vector is shared by all
thresholds t_1 < t_2 < ..., so the grades stay ordered. The output is the
expected severity, the sum of P(grade >= j) over the thresholds.

Features are sparse: words and prefixes of words, valued by how often they
occur per thousand words. Only features that a likelihood-ratio test ties to
toxic documents get a weight.

``labels`` says toxic or not. Grades are made from it: 0 for documents that
are not toxic, and for toxic ones 1, 2 or 3 by the share of their words that
carry a tied feature (``GRADE_CUTS``).

The model is fitted on a bounded sample: at most ``FIT_DOCS`` rows of either
label, those of the smallest hash of id and text, however many rows share a
labelled id; repeated rows count once. Features are counted by Spark; at most
``FEATURES`` of them, the most strongly tied, reach the driver and get weights.
Every document is scored on its whole text.

Both labels weigh alike in the fit, though most documents are clean. A document
therefore counts as toxic only from odds of 4 to 1 on (``TOXIC_AT``).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows, written

FIT_DOCS = 8000
FEATURES = 2000
#: Least P(grade >= 1) of a toxic document.
TOXIC_AT = 0.8
PREFIXES = (4, 5)
#: Shares of words with a tied feature from which a toxic document has grade 2, 3.
GRADE_CUTS = (0.02, 0.05)
#: A tied feature is at least so many times as frequent among toxic documents.
LEAST_RATIO = 5.0
TOKEN = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """The word and its prefixes; a prefix ends in ``*``."""
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) >= n]]


def feature_counts(text: str, wanted: dict | None = None) -> tuple[Counter, int, int]:
    """How often each (wanted) feature occurs, words that carry one, words."""
    words = Counter(TOKEN.findall(text.lower()))
    found: Counter = Counter()
    hits = 0
    for word, n in words.items():
        own = [f for f in features(word) if wanted is None or f in wanted]
        hits += n * bool(own)
        for f in own:
            found[f] += n
    return found, hits, words.total()


def value(n: int, words: int) -> float:
    return math.log1p(1000 * n / words)


@dataclass
class OrdinalModel:
    weights: dict[str, float]
    thresholds: list[float]  # one for each grade from 1

    def probabilities(self, text: str) -> list[float]:
        """P(grade >= j) for each threshold."""
        found, _, words = feature_counts(text, self.weights)
        score = sum(self.weights[f] * value(n, words) for f, n in found.items())
        return [1 / (1 + math.exp(min(700.0, t - score))) for t in self.thresholds]


def train(rows: list[list[tuple[int, float]]], grades: np.ndarray, n_features: int, steps: int = 400, l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds that maximise the likelihood (Adam, all
    rows at once). ``grades`` are 0, 1, ... without gaps."""
    at = np.array([i for i, r in enumerate(rows) for _ in r], np.int64)
    col = np.array([c for r in rows for c, _ in r], np.int64)
    val = np.array([v for r in rows for _, v in r])
    k = int(grades.max())
    share = np.array([(grades >= j).mean() for j in range(1, k + 1)])
    start = np.log((1 - share) / share)
    # thresholds: the first, then the logs of the steps up
    p = np.concatenate((np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    m, s = np.zeros_like(p), np.zeros_like(p)
    rate = np.full(len(p), 0.05)
    weight = np.where(grades > 0, 0.5 / max(1, (grades > 0).sum()), 0.5 / max(1, (grades == 0).sum()))  # both labels count alike
    below = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, steps + 1):
        t = np.cumsum(np.concatenate((p[n_features : n_features + 1], np.exp(p[n_features + 1 :]))))
        score = np.bincount(at, p[col] * val, len(rows)) if len(at) else np.zeros(len(rows))
        edge = np.concatenate(([-np.inf], t, [np.inf]))
        upper, lower = edge[grades + 1] - score, edge[grades] - score  # P(y) = F(upper) - F(lower)
        fu, fl = np.where(np.isinf(upper), 1.0, below(upper)), np.where(np.isinf(lower), 0.0, below(lower))
        du, dl = fu * (1 - fu), fl * (1 - fl)
        prob = np.maximum(fu - fl, 1e-12)
        d_score = weight * (du - dl) / prob  # of the negative log-likelihood
        g = np.zeros_like(p)
        if len(at):
            g[:n_features] = np.bincount(col, d_score[at] * val, n_features)
        g[:n_features] += l2 * p[:n_features]
        d_t = np.zeros(k)
        np.add.at(d_t, np.minimum(grades, k - 1), np.where(grades < k, -weight * du / prob, 0))
        np.add.at(d_t, np.maximum(grades - 1, 0), np.where(grades > 0, weight * dl / prob, 0))
        after = np.cumsum(d_t[::-1])[::-1]  # a step up moves all thresholds after it
        g[n_features] = after[0]
        g[n_features + 1 :] = after[1:] * np.exp(p[n_features + 1 :])
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-9)
    return p[:n_features], np.cumsum(np.concatenate((p[n_features : n_features + 1], np.exp(p[n_features + 1 :]))))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    usable: Column | None = None, fit_docs: int = FIT_DOCS,
) -> OrdinalModel | None:
    """Fit on a bounded sample of the labelled documents (of those ``usable``
    by their id, if given). All rows that share a labelled id have its label;
    an id that is labelled both ways is toxic. None if not both labels have rows."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    if usable is not None:
        known = known.filter(usable)
    known = written(known.groupBy("id").agg((F.max("y") > 0).cast("int").alias("y")), "toxicity-labels")
    hashed = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    hashed = hashed.withColumn("h", F.xxhash64("id", "t"))
    # The rows of the smallest hashes of either label: found without their texts, then fetched by a list of bounded length.
    hashes = written(hashed.select("id", "h").join(known, "id").select("y", "h").distinct(), "toxicity-hashes")
    least = [hashes.filter(F.col("y") == y).orderBy("h").limit(fit_docs) for y in (0, 1)]
    chosen = written(least[0].unionByName(least[1]), "toxicity-chosen")  # at most 2 * fit_docs numbers
    if chosen.select("y").distinct().count() < 2:
        return None
    sample = written(hashed.join(F.broadcast(chosen), "h").dropDuplicates(["y", "h"]), "toxicity-sample")

    def seen(batch: pa.RecordBatch) -> pa.RecordBatch:
        y, names = [], []
        for label, text in zip(batch.column("y").to_pylist(), batch.column("t").to_pylist(), strict=True):
            own = list(feature_counts(text)[0])
            y += [label] * len(own)
            names += own
        return pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(names, pa.string())], ["y", "f"])

    total = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    counted = map_rows(sample, seen, "y int, f string").groupBy("f").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    counted = written(counted, "toxicity-features")
    n1, n0 = float(total[1]), float(total[0])
    a, b = F.col("a"), F.col("b")

    def cell(o: Column, e: Column) -> Column:
        return F.when(o > 0, 2 * o * F.log(o / e)).otherwise(0.0)

    both = (a + b) / (n1 + n0)
    g2 = cell(a, n1 * both) + cell(b, n0 * both) + cell(n1 - a, n1 * (1 - both)) + cell(n0 - b, n0 * (1 - both))
    # A level that chance alone reaches for about one in all features.
    level = 2 * math.log(max(2, counted.count()))
    tied = counted.withColumn("g2", g2).filter((F.col("g2") >= level) & ((a + 0.5) / n1 >= LEAST_RATIO * (b + 0.5) / n0))
    chosen_features = [r["f"] for r in tied.orderBy(F.desc("g2"), "f").limit(FEATURES).collect()]
    index = {f: i for i, f in enumerate(sorted(chosen_features))}

    def vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {"y": [], "share": [], "cols": [], "vals": []}
        for label, text in zip(batch.column("y").to_pylist(), batch.column("t").to_pylist(), strict=True):
            found, hits, words = feature_counts(text, index)
            out["y"].append(label)
            out["share"].append(hits / max(1, words))
            out["cols"].append([index[f] for f in sorted(found)])
            out["vals"].append([value(found[f], words) for f in sorted(found)])
        kinds = [pa.int32(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    got = map_rows(sample.orderBy("id", "t"), vectors, "y int, share double, cols array<int>, vals array<double>").collect()
    y = np.array([r["y"] for r in got])
    severity = np.array([r["share"] for r in got])
    grades = np.where(y > 0, 1 + np.sum([severity >= c for c in GRADE_CUTS], axis=0), 0)
    present, dense = np.unique(grades, return_inverse=True)  # grades that no document has get no threshold of their own
    w, t = train([list(zip(r["cols"], r["vals"], strict=True)) for r in got], dense, len(index))
    thresholds = [float(t[np.searchsorted(present, j) - 1]) if j <= present[-1] else math.inf for j in range(1, len(GRADE_CUTS) + 2)]
    return OrdinalModel({f: float(w[i]) for f, i in index.items()}, thresholds)


def score(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, expected_severity, grade, toxic)`` for every row.

    ``grade`` is 0 where P(grade >= 1) is below ``TOXIC_AT``, else the largest
    grade that is as likely as not; ``toxic`` is grade >= 1. Null and empty texts, and all texts without a model, have
    severity 0. Repeated rows stay repeated, null ids are kept, other columns
    are not read.
    """

    @F.arrow_udf("struct<severity: double, grade: int>")
    def severity(texts: pa.Array) -> pa.Array:
        p = [model.probabilities(t) if model and t else [] for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([sum(x) for x in p], pa.float64()), pa.array([sum(q >= 0.5 for q in x) if x and x[0] >= TOXIC_AT else 0 for x in p], pa.int32())], names=["severity", "grade"]
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), severity(F.coalesce(F.col(text_col), F.lit(""))).alias("s"))
    return rows.select("doc_id", F.col("s.severity").cast("double").alias("expected_severity"), F.col("s.grade").alias("grade"), (F.col("s.grade") >= 1).alias("toxic"))
