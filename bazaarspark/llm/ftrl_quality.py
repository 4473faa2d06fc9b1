"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

Tokens are words and runs of other signs. One- and two-token sequences are hashed into a fixed number of weights; a
text's value of a feature is its count divided by the square root of the text's number of features. A score is the
logistic function of one sparse dot product.

Defined results: null and empty texts are scored by the bias alone; repeated rows are scored alike; without labelled
rows of both classes the score is the smoothed share of class 1; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, crc32_of, labelled_sample, quoted, some_bytes, texts_of

WEIGHTS = 1 << 18
SAMPLE = 6000  # labelled rows that are learnt from, at most
EPOCHS = 3
TOKEN = re.compile(r"\w+|[^\w\s]+")
REMEMBERED = 100_000


class Tokens:
    """Token digests, remembered for the length of a task."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def digests(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        tokens = TOKEN.findall(text)
        try:
            found = [known[t] for t in tokens]
        except KeyError:
            for t in tokens:
                if t not in known:
                    known[t] = zlib.crc32(t.encode("utf-8", "surrogatepass"))
            found = [known[t] for t in tokens]
        return np.array(found, np.uint64)


def features(text: str, tokens: Tokens) -> np.ndarray:
    """Weight numbers of the text's one- and two-token sequences, repeats included. Number 0 is the bias."""
    d = tokens.digests(text)
    if not len(d):
        return np.zeros(0, np.int64)
    pairs = (d[:-1] * np.uint64(0x9E3779B97F4A7C15) + d[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)
    pairs[d[:-1] == d[1:]] = 0  # a token said twice is one feature, whatever the token
    return (np.concatenate([d, pairs]) % np.uint64(WEIGHTS - 1) + np.uint64(1)).astype(np.int64)


class Ftrl:
    """Per-coordinate follow-the-regularised-leader with logistic loss."""

    def __init__(self, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(WEIGHTS), np.zeros(WEIGHTS)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / step)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def trained(rows: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Weights from labelled texts; the same rows give the same weights."""
    total = sum(y for _, y in rows)
    if total in (0, len(rows)):
        out = np.zeros(WEIGHTS)
        out[0] = np.log((total + 1) / (len(rows) - total + 1))
        return out.astype(np.float32)
    vectors, tokens = [], Tokens()
    for text, y in rows:
        f = features(text, tokens)
        at, counts = np.unique(f, return_counts=True)
        vectors.append((np.append(at, 0), np.append(counts / np.sqrt(max(1, len(f))), 1.0), y))
    model, rng = Ftrl(), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(vectors)):
            model.learn(*vectors[i])
    return model.weights().astype(np.float32)


def scores(texts: list[str], weights: np.ndarray, tokens: Tokens | None = None) -> np.ndarray:
    tokens = Tokens() if tokens is None else tokens
    found = [features(t, tokens) for t in texts]
    dots = np.array([weights[f].sum(dtype=np.float64) / np.sqrt(max(1, len(f))) for f in found]) + weights[0]
    return 1 / (1 + np.exp(-np.clip(dots, -35, 35)))


def scored(docs: DataFrame, weights: np.ndarray, keep: list[str]) -> DataFrame:
    """`keep` columns and the score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def work(batches):
        tokens = Tokens()
        for batch in some_bytes(batches):
            found = scores(texts_of(batch), shared.value, tokens)
            yield pa.record_batch([*(batch.column(k) for k in keep), pa.array(found)], [*keep, "quality_score"])

    schema = ", ".join(f"{quoted(k)} {docs.schema[k].dataType.simpleString()}" for k in keep)
    return arrow(docs.select(*dict.fromkeys([*keep, "text"])), work, f"{schema}, quality_score double")


def held_out() -> Column:
    return F.coalesce(crc32_of("doc_id") % 3 == 1, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> np.ndarray:
    """Weights learnt from the labelled documents that are not held out."""
    return trained(labelled_sample(docs, labels, "quality", ~held_out(), most))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    found = scored(docs, quality_model(docs, labels), ["doc_id"])
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


def kept_by_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents, all their columns unchanged, whose score reaches the threshold."""
    names, weights = docs.columns, quality_model(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    at = names.index("text")

    def work(batches):
        tokens = Tokens()
        for batch in some_bytes(batches):
            texts = ["" if t is None else t for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(scores(texts, shared.value, tokens) >= threshold))

    return arrow(docs, work, docs.schema)
