"""Quality by a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its words hashed into buckets (weights by square roots of counts, normed to 1) and
one bucket for each of its binned statistics (symbols, capitals, digits, repeated lines and words, table bars, line and
word lengths) and of its length in characters. The score is a logistic curve over a bias, linear weights and
all pairwise interactions of low-rank factors; the sum over pairs is half of (the squared sum minus the sum of
squares), so scoring is linear in the number of features.

Weights are learnt on a bounded, documented sample of labelled rows (MOST of each class, none of the held-out
fold) by AdaGrad, and broadcast at a fixed size of BUCKETS * (1 + RANK) numbers. Scoring reads every whole text in
one pass without a shuffle.

Defined cases: a null or empty text is scored by its statistics alone; equal texts score equally; repeated rows
stay; without labelled rows every score is 0.5; empty tables give no rows; lang, source, doc_id and
any other columns are never inputs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, held_out, labelled_sample, with_ids

MOST = {0: 3000, 1: 3000}
BUCKETS = 1 << 16
STATISTICS, BINS = 12, 12  # the first STATISTICS * BINS buckets hold binned statistics
RANK = 8
EPOCHS = 12
SYMBOLS = re.compile(r"[^\w\s.,;:'\"()-]")
_DIGITS, _MARKS = re.compile(r"\d+"), re.compile(r"[!?.,;:]")


class Features:
    """Sparse vectors of texts, with a bounded cache of hashed words for each worker."""

    def __init__(self, cache: int = 200_000):
        self.cache, self.most = {}, cache

    def bucket(self, word: str) -> int:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= self.most:
                self.cache.clear()
            found = self.cache[word] = STATISTICS * BINS + zlib.crc32(word.encode()) % (BUCKETS - STATISTICS * BINS)
        return found

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, weights)"""
        words, lines, n = text.split(), text.split("\n"), max(1, len(text))
        counts = Counter(words)
        distinct_lines = set(lines)
        upper = sum(map(str.isupper, counts))
        shares = [
            len(SYMBOLS.findall(text)) / n * 8,
            upper / max(1, len(counts)),
            sum(map(len, _DIGITS.findall(text))) / n * 4,
            len(_MARKS.findall(text)) / n * 8,
            1 - len(counts) / max(1, len(words)),
            1 - len(distinct_lines) / len(lines),
            text.count("|") / max(1, len(words)),
            counts.most_common(1)[0][1] / len(words) if words else 1.0,
        ]
        sizes = [n, len(words), n / max(1, len(words)), n / len(lines)]
        bins = [min(BINS - 1, int(s * BINS)) for s in shares] + [min(BINS - 1, int(np.log2(1 + s) * 0.9)) for s in sizes]
        statistics = np.arange(STATISTICS) * BINS + np.array(bins)
        if not words:
            return statistics, np.full(STATISTICS, 0.5)
        hashed = np.fromiter(map(self.bucket, counts), np.int64, len(counts))
        weights = np.sqrt(np.fromiter(counts.values(), float, len(counts)))
        return np.concatenate([statistics, hashed]), np.concatenate([np.full(STATISTICS, 0.5), weights / np.sqrt((weights**2).sum())])


class Machine:
    """bias + w.x + sum over pairs of <v_i, v_j> x_i x_j"""

    def __init__(self, seed: int = 7):
        self.bias, self.w = 0.0, np.zeros(BUCKETS)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (BUCKETS, RANK))

    def raw(self, index: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        xv = x[:, None] * self.v[index]
        total = xv.sum(0)
        return self.bias + self.w[index] @ x + 0.5 * float((total**2 - (xv**2).sum(0)).sum()), total

    def score(self, index: np.ndarray, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(index, x)[0], -30, 30))))

    def learn(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> None:
        """AdaGrad on the logistic loss, the classes weighing equally."""
        order = np.random.default_rng(seed)
        weight = {c: len(labels) / (2 * max(1, (labels == c).sum())) for c in (0, 1)}
        g_bias, g_w, g_v = 1e-3, np.full(BUCKETS, 1e-3), np.full((BUCKETS, RANK), 1e-3)
        for _ in range(epochs):
            for k in order.permutation(len(rows)):
                index, x = rows[k]
                raw, total = self.raw(index, x)
                d = weight[labels[k]] * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[k])
                v = self.v[index]
                of_w = d * x + decay * self.w[index]
                of_v = d * x[:, None] * (total - x[:, None] * v) + decay * v
                # A document's words have distinct indices but for hash collisions, whose last step counts.
                g_bias += d * d
                g_w[index] += of_w**2
                g_v[index] += of_v**2
                self.bias -= rate * d / np.sqrt(g_bias)
                self.w[index] -= rate * of_w / np.sqrt(g_w[index])
                self.v[index] -= 0.5 * rate * of_v / np.sqrt(g_v[index])


def fit(docs: DataFrame, labels: DataFrame, most: dict[int, int] | None = None) -> Machine:
    """A machine learnt on the sample; its vectors are made on the executors and are all that comes to the driver."""

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            found = [features.of(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "label": batch["label"].to_numpy(), "index": [f[0].astype(np.int32) for f in found], "x": [f[1].astype(np.float32) for f in found]})

    sample = labelled_sample(docs.sparkSession, docs, labels, "quality", most or MOST)
    rows = sample.mapInPandas(vectors, "doc_id long, label int, index array<int>, x array<float>").toPandas().sort_values("doc_id", kind="stable")
    machine = Machine()
    if rows["label"].nunique() == 2:
        machine.learn([(np.asarray(i), np.asarray(x, float)) for i, x in zip(rows["index"], rows["x"])], rows["label"].to_numpy())
    return machine


def score(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine, features = shared.value, Features()
        for batch in batches:
            s = np.array([machine.score(*features.of(t)) for t in batch["text"]], float)
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "score": s, "predicted": (s >= threshold).astype(np.int32)})

    return with_ids(doc_texts(docs).mapInPandas(scored, "doc_id long, score double, predicted int"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
