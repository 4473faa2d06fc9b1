"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs, in numpy.

A word enters as its hashed embedding next to the mean of its hashed character 3- to 5-gram embeddings. Texts are cut
into overlapping windows of `WINDOW` words, `STRIDE` apart, to their ends; all are scored, and a text's score is the
logistic function of its highest window. Training spreads a text's gradient over its windows by a softmax of their
scores, so that the windows that matter learn the label.

A word's share of all gate inputs does not depend on its neighbours: it is computed once per distinct word of a worker.

Defined results: null and empty texts are one window without words, scored by the bias alone; repeated rows are scored
alike; texts of any length are scored whole; without labelled rows of both classes every score is the smoothed share of
class 1; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, crc32_of, labelled_sample, some_bytes, texts_of

WORD = re.compile(r"\w+")
WORDS, GRAMS = 1 << 14, 1 << 15  # rows of the hashed embeddings
DIM, HIDDEN = 12, 8
WINDOW, STRIDE = 40, 32
SAMPLE = 3000  # labelled rows that are learnt from, at most
PASSES = 6000  # texts shown in training: the sample again and again, twice at least
CHUNK = 512  # windows computed together
REMEMBERED = 150_000  # distinct words a worker keeps


def parameters(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {
        "words": init(WORDS, DIM) * np.float32(np.sqrt(WORDS) * 0.1),
        "grams": init(GRAMS, DIM) * np.float32(np.sqrt(GRAMS) * 0.3),
        "attend": np.zeros(2 * HIDDEN, np.float32),
        "out": init(2 * HIDDEN),
        "bias": np.zeros(1, np.float32),
    }
    for side in "fb":  # forward and backward
        p[f"in_{side}"] = init(2 * DIM, 3 * HIDDEN)
        p[f"gate_{side}"] = init(HIDDEN, 2 * HIDDEN)
        p[f"new_{side}"] = init(HIDDEN, HIDDEN)
        p[f"b_{side}"] = np.zeros(3 * HIDDEN, np.float32)
    return p


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of the words' character n-grams, word by word, and how many each word has (one at least)."""
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(m) for m in marked])
    rows, owners = [], []
    for n in (3, 4, 5):
        digest = np.zeros(max(0, len(codes) - n + 1), np.uint64)
        for k in range(n):
            digest = digest * np.uint64(0x100000001B3) + codes[k : k + len(digest)]
        inside = owner[: len(digest)] == owner[n - 1 :]
        mixed = digest[inside] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
        rows.append((mixed % np.uint64(GRAMS)).astype(np.int64))
        owners.append(owner[: len(digest)][inside])
    # The empty word, which pads windows, has no n-gram of its own.
    counts = np.bincount(np.concatenate(owners), minlength=len(words))
    bare = np.flatnonzero(counts == 0)
    rows.append(np.zeros(len(bare), np.int64))
    owners.append(bare)
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(rows)[order], np.maximum(counts, 1)


def word_row(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORDS


def windows(n: int) -> list[tuple[int, int]]:
    """(start, end) of the overlapping windows of n words; one empty window when there are none."""
    starts = range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)
    return [(s, min(n, s + WINDOW)) for s in starts]


def direction(p, side: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (time, window, HIDDEN) from gate inputs x (time, window, 3 HIDDEN); masked steps carry the state."""
    gate, new = p[f"gate_{side}"], p[f"new_{side}"]
    steps, n, _ = x.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((steps, n, HIDDEN), np.float32)
    full = mask.all(axis=(1, 2))
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        zr = x[t, :, : 2 * HIDDEN] + h @ gate
        np.tanh(np.multiply(zr, 0.5, out=zr), out=zr)
        zr = np.add(np.multiply(zr, 0.5, out=zr), 0.5, out=zr)
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        u = h @ new
        c = r * u
        c += x[t, :, 2 * HIDDEN :]
        np.tanh(c, out=c)
        if keep is not None:
            keep.append((t, h, z, r, u, c))
        move = (1 - z) * (c - h)
        h = h + (move if full[t] else mask[t] * move)
        out[t] = h
    return out


def summed(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values that share a row number below n."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    begin = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    out = np.zeros((n, values.shape[1]), np.float32)
    out[ordered[begin]] = np.add.reduceat(values[order], begin)
    return out


def pooled(p, states: np.ndarray, mask: np.ndarray):
    """Window scores, the attention and the context; states are (time, window, 2 HIDDEN)."""
    e = states @ p["attend"]
    e = np.where(mask[:, :, 0] > 0, e, -np.inf)
    top = e.max(axis=0)
    a = np.exp(e - np.where(np.isfinite(top), top, 0))
    total = a.sum(axis=0)
    a /= np.where(total > 0, total, 1)
    context = np.einsum("tn,tnd->nd", a, states)
    return context @ p["out"] + p["bias"][0], a, context


class Learner:
    """Adagrad on the network's gradients."""

    def __init__(self, seed: int = 11, rate: float = 0.08):
        self.p = parameters(seed)
        self.rate = rate
        self.seen = {k: np.full(v.shape, 1e-6, np.float32) for k, v in self.p.items()}

    def step(self, name: str, g: np.ndarray, at=slice(None)) -> None:
        self.seen[name][at] += g * g
        self.p[name][at] -= self.rate * g / np.sqrt(self.seen[name][at])

    def learn(self, docs: list[tuple[list[int], int]], word_at: np.ndarray, grams: list[np.ndarray]) -> float:
        """One step on a few texts, each the numbers of its words and its label."""
        p = self.p
        spans = [(d, s, e) for d, (ids, _) in enumerate(docs) for s, e in windows(len(ids))]
        n = len(spans)
        at, mask = np.zeros((WINDOW, n), np.int64), np.zeros((WINDOW, n, 1), np.float32)
        for k, (d, s, e) in enumerate(spans):
            at[: e - s, k] = docs[d][0][s:e]
            mask[: e - s, k] = 1
        used, inverse = np.unique(at, return_inverse=True)
        inverse = inverse.reshape(at.shape)
        flat = np.concatenate([grams[i] for i in used])
        sizes = np.array([len(grams[i]) for i in used])
        begin = np.cumsum(sizes) - sizes
        v = np.concatenate(
            [p["words"][word_at[used]], np.add.reduceat(p["grams"][flat], begin) / sizes[:, None]], axis=1
        ).astype(np.float32)
        x = {s: (v @ p[f"in_{s}"] + p[f"b_{s}"])[inverse] for s in "fb"}
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([direction(p, s, x[s], mask, kept[s]) for s in "fb"], axis=2)
        logit, a, context = pooled(p, states, mask)

        # Loss: logistic loss of a smooth maximum over the windows of each text.
        owner = np.array([d for d, _, _ in spans])
        top = np.full(len(docs), -np.inf)
        np.maximum.at(top, owner, logit)
        soft = np.exp(logit - top[owner])
        total = np.bincount(owner, soft, len(docs))
        score = top + np.log(total)
        y = np.array([label for _, label in docs], float)
        error = 1 / (1 + np.exp(-np.clip(score, -35, 35))) - y
        d_logit = (error[owner] * soft / total[owner] / len(docs)).astype(np.float32)

        g_out, g_bias = context.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_context = d_logit[:, None] * p["out"]
        d_states = a[:, :, None] * d_context
        d_a = np.einsum("tnd,nd->tn", states, d_context)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        g_attend = np.einsum("tn,tnd->d", d_e, states)
        d_states += d_e[:, :, None] * p["attend"]

        d_v = np.zeros_like(v)
        gradients = {"out": g_out, "bias": g_bias, "attend": g_attend}
        for side, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            gate, new = p[f"gate_{side}"], p[f"new_{side}"]
            d_x = np.empty_like(x[side])
            g_gate, g_new = np.zeros_like(gate), np.zeros_like(new)
            d_h = np.zeros((n, HIDDEN), np.float32)
            for t, h, z, r, u, c in reversed(kept[side]):
                d = d_h + d_states[t, :, part]
                m = mask[t]
                d_c = d * m * (1 - z) * (1 - c * c)
                d_u = d_c * r
                d_zr = np.concatenate([d * m * (h - c) * z * (1 - z), d_c * u * r * (1 - r)], axis=1)
                d_x[t] = np.concatenate([d_zr, d_c], axis=1)
                g_gate += h.T @ d_zr
                g_new += h.T @ d_u
                d_h = d * (1 - m * (1 - z)) + d_zr @ gate.T + d_u @ new.T
            by_word = summed(d_x.reshape(-1, 3 * HIDDEN), inverse.reshape(-1), len(used))
            gradients |= {f"gate_{side}": g_gate, f"new_{side}": g_new, f"b_{side}": by_word.sum(axis=0)}
            gradients[f"in_{side}"] = v.T @ by_word
            d_v += by_word @ p[f"in_{side}"].T
        for name, g in gradients.items():
            self.step(name, g)
        rows, back = np.unique(word_at[used], return_inverse=True)
        self.step("words", summed(d_v[:, :DIM], back, len(rows)), rows)
        rows, back = np.unique(flat, return_inverse=True)
        by_gram = np.repeat(d_v[:, DIM:] / sizes[:, None].astype(np.float32), sizes, axis=0)
        self.step("grams", summed(by_gram, back, len(rows)), rows)
        loss = np.logaddexp(0, score) - y * score
        return float(loss.mean())


def trained(rows: list[tuple[str, int]], seed: int = 11, group: int = 16) -> dict[str, np.ndarray]:
    """The network's parameters from labelled texts; the same rows give the same parameters."""
    learner = Learner(seed)
    positive = sum(y for _, y in rows)
    if positive in (0, len(rows)):
        learner.p["out"][:] = 0
        learner.p["bias"][0] = np.log((positive + 1) / (len(rows) - positive + 1))
        return learner.p
    numbers: dict[str, int] = {"": 0}
    docs = []
    for text, y in rows:
        ids = [numbers.setdefault(w, len(numbers)) for w in WORD.findall(text.lower())]
        docs.append((ids, y))
    word_at = np.array([word_row(w) for w in numbers])
    flat, sizes = gram_rows(list(numbers))
    grams = np.split(flat, np.cumsum(sizes)[:-1])
    # A rare class is shown as often as a third of the other.
    for y in (0, 1):
        few, rest = [d for d in docs if d[1] == y], sum(d[1] != y for d in docs)
        docs += few * max(0, min(8, rest // (3 * len(few))) - 1)
    rng = np.random.default_rng(seed)
    epochs = min(24, max(2, -(-PASSES // len(docs))))
    for epoch in range(epochs):
        learner.rate = 0.08 / (1 + 3 * epoch / epochs)
        order = rng.permutation(len(docs))
        for i in range(0, len(order), group):
            learner.learn([docs[k] for k in order[i : i + group]], word_at, grams)
    return learner.p


class Scorer:
    """Scores of whole texts; what a word adds to the gates is computed once."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.gates = {s: np.zeros((1, 3 * HIDDEN), np.float32) for s in "fb"}

    def add(self, words: list[str]) -> None:
        p = self.p
        flat, sizes = gram_rows(words)
        begin = np.cumsum(sizes) - sizes
        v = np.concatenate(
            [
                p["words"][[word_row(w) for w in words]],
                np.add.reduceat(p["grams"][flat], begin) / sizes[:, None],
            ],
            axis=1,
        ).astype(np.float32)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        for s in "fb":
            self.gates[s] = np.concatenate([self.gates[s], v @ p[f"in_{s}"] + p[f"b_{s}"]])

    def scores(self, texts: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.forget()
        cut = [WORD.findall(t.lower()) for t in texts]
        known = self.known
        new = list({w for words in cut for w in words if w not in known})
        if new:
            self.add(new)
        ids = known.__getitem__
        best = np.full(len(texts), -np.inf)
        flat = np.array([i for words in cut for i in map(ids, words)], np.int64)
        base, owners, starts, ends = 0, [], [], []
        for d, words in enumerate(cut):
            for s, e in windows(len(words)):
                owners.append(d)
                starts.append(base + s)
                ends.append(base + e)
            base += len(words)
        flat = np.append(flat, np.zeros(WINDOW, np.int64))
        owner, start, end = np.array(owners), np.array(starts), np.array(ends)
        steps = np.arange(WINDOW)[:, None]
        for i in range(0, len(owner), CHUNK):
            part = slice(i, i + CHUNK)
            mask = (start[part] + steps < end[part])[:, :, None].astype(np.float32)
            at = flat[start[part] + steps]
            states = np.concatenate([direction(self.p, s, self.gates[s][at], mask) for s in "fb"], axis=2)
            np.maximum.at(best, owner[part], pooled(self.p, states, mask)[0])
        return 1 / (1 + np.exp(-np.clip(best, -35, 35)))


def held_out() -> Column:
    return F.coalesce(crc32_of("doc_id") % 5 == 0, F.lit(False))


def toxicity_model(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> dict[str, np.ndarray]:
    return trained(labelled_sample(docs, labels, "toxic", ~held_out(), most))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(toxicity_model(docs, labels))  # of fixed size
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        scorer = Scorer(shared.value)
        for batch in some_bytes(batches, most=4 << 20):
            found = scorer.scores(texts_of(batch))
            yield pa.record_batch([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    found = arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double")
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
