"""Scores and targets restated plainly: one text, one window, one word, one number at a time."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest

from bazaarspark.llm import cube_mixing, ftrl_quality, gated_toxicity
from bazaarspark.llm.common import labelled_sample, table
from tests.llm.helpers import hard_docs, text

SMALL = "/root/testdata/sf0.001"


def quality_of(whole: str, weights) -> float:
    """The quality score of a text from the weights."""
    tokens = [zlib.crc32(t.encode()) for t in re.findall(r"\w+|[^\w\s]+", whole)]
    found = [t % (ftrl_quality.WEIGHTS - 1) + 1 for t in tokens]
    for a, b in zip(tokens, tokens[1:]):
        pair = 0 if a == b else ((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % (1 << 64)) >> 40
        found.append(pair % (ftrl_quality.WEIGHTS - 1) + 1)
    dot = float(weights[0]) + sum(float(weights[f]) for f in found) / math.sqrt(max(1, len(found)))
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, dot))))


def test_quality_scores_of_a_whole_table(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    weights = ftrl_quality.trained(labelled_sample(docs, labels, "quality", ~ftrl_quality.held_out(), ftrl_quality.SAMPLE))
    found = {r["doc_id"]: r["score"] for r in ftrl_quality.quality_scores(docs, labels).collect()}
    for r in docs.collect():
        assert found[r["doc_id"]] == pytest.approx(quality_of(r["text"] or "", weights), abs=1e-6)


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def word_vector(p, word: str) -> list[float]:
    """Hashed embedding of a word next to the mean of those of its character n-grams."""
    own = p["words"][zlib.crc32(word.encode()) % gated_toxicity.WORDS]
    marked, grams = [ord(c) for c in f"<{word}>"], []
    for n in (3, 4, 5):
        for i in range(len(marked) - n + 1):
            d = 0
            for c in marked[i : i + n]:
                d = (d * 0x100000001B3 + c) % (1 << 64)
            grams.append(p["grams"][(d * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % gated_toxicity.GRAMS])
    return [*map(float, own), *(float(sum(g[k] for g in grams)) / len(grams) for k in range(gated_toxicity.DIM))]


def toxicity_of(whole: str, p) -> float:
    """The highest window's score, step by step in both directions."""
    size, words = gated_toxicity.HIDDEN, re.findall(r"\w+", whole.lower())
    vectors = [np.array(word_vector(p, w)) for w in words]
    best, start = -math.inf, 0
    while True:
        part = vectors[start : start + gated_toxicity.WINDOW]
        sides = []
        for side, order in (("f", part), ("b", part[::-1])):
            h, states = np.zeros(size), []
            for v in order:
                x = v @ p[f"in_{side}"] + p[f"b_{side}"]
                gate = h @ p[f"gate_{side}"]
                z = [sigmoid(a) for a in x[:size] + gate[:size]]
                r = [sigmoid(a) for a in x[size : 2 * size] + gate[size:]]
                c = [math.tanh(a) for a in x[2 * size :] + np.array(r) * (h @ p[f"new_{side}"])]
                h = (1 - np.array(z)) * np.array(c) + np.array(z) * h
                states.append(h)
            sides.append(states if side == "f" else states[::-1])
        states = [np.concatenate(s) for s in zip(*sides)]
        shares = [math.exp(float(s @ p["attend"])) for s in states]
        context = sum((w * s for w, s in zip(shares, states)), np.zeros(2 * size)) / (sum(shares) or 1)
        best = max(best, float(context @ p["out"]) + float(p["bias"][0]))
        start += gated_toxicity.STRIDE
        if start >= max(1, len(words) - (gated_toxicity.WINDOW - gated_toxicity.STRIDE)):
            return sigmoid(max(-35.0, min(35.0, best)))


def test_toxicity_of_texts_of_all_lengths():
    rows = [(f"{text(i, 50)} {'vile grobnik' if i % 2 else 'kind words'}", i % 2) for i in range(60)]
    p = gated_toxicity.trained(rows)
    texts = ["", "one", "Ünï 漢字 <x> _a_", *(" ".join(text(n, 200).split()[:n]) for n in (2, 8, 9, 39, 40, 41, 48, 49, 72, 73, 130))]
    found = gated_toxicity.Scorer(p).scores(texts)
    assert found == pytest.approx([toxicity_of(t, p) for t in texts], abs=2e-4)


def test_toxicity_scores_of_a_whole_table(spark):
    docs, labels = table(spark, SMALL, "documents").limit(40), table(spark, SMALL, "labels")
    p = gated_toxicity.toxicity_model(docs, labels)
    found = {r["doc_id"]: r for r in gated_toxicity.toxicity_scores(docs, labels).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    for r in rows:
        assert found[r["doc_id"]]["score"] == pytest.approx(toxicity_of(r["text"] or "", p), abs=2e-4)
        assert found[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_mixing_columns_of_a_whole_table(spark):
    for docs in (table(spark, SMALL, "documents"), hard_docs(spark)):
        rows = docs.collect()
        size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes = collections.Counter()
        for r in rows:
            sizes[r["source"]] += size(r["text"])
        names = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        target: dict = {}
        left, open_ = float(sum(sizes.values())), list(names)
        while True:  # shares by weight; a source above three times its size is closed at that, its excess dealt again
            share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
            above = [s for s in open_ if share[s] > 3 * sizes[s]]
            if not above:
                target |= share
                break
            for s in above:
                target[s] = 3.0 * sizes[s]
                left -= target[s]
                open_.remove(s)
        by_key = collections.defaultdict(set)
        for r in rows:
            by_key[r["doc_id"], size(r["text"])].add(r["source"])
        for r in cube_mixing.mixing_plan(docs).collect():
            sources = by_key[r["doc_id"], r["size"]]
            assert any(
                r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s], rel=1e-6) for s in sources
            ), (r, sources)
