"""Held-out accuracy and defined results of the two classifiers."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from bazaarspark.llm import ftrl_quality, gated_toxicity
from bazaarspark.llm.common import table
from tests.llm.helpers import empty_docs, hard_docs, text, with_clashes

TABLES = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, TABLES, "documents"), table(spark, TABLES, "labels")
    found = {r["doc_id"]: r for r in ftrl_quality.quality_scores(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    known = [(found[r["doc_id"]], r["quality"]) for r in labels.collect() if found[r["doc_id"]]["held_out"]]
    assert np.mean([r["predicted"] == y for r, y in known]) >= 0.97
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in found.values())


def test_toxicity_learns_and_generalises_to_held_out_texts():
    rng = np.random.default_rng(8)
    bad = ["grobnik", "grobnikka", "zlotra", "zlotrano"]

    def sample(n):
        out = []
        for i in range(n):
            words = text(int(rng.integers(1 << 30)), 50).split()
            label = int(i % 2)
            if label:
                for k in rng.choice(len(words), 4):
                    words[k] = str(rng.choice(bad))
            out.append((" ".join(words), label))
        return out

    p = gated_toxicity.trained(sample(400))
    held = sample(200)
    scores = gated_toxicity.Scorer(p).scores([t for t, _ in held])
    assert np.mean((scores >= 0.5) == np.array([y for _, y in held])) >= 0.97
    again = gated_toxicity.trained(sample(2) + sample(2))
    assert set(again) == set(p)


def test_gradients_of_the_network():
    """One small step against the gradient lowers the loss."""
    rows = [(text(i, 40), i % 2) for i in range(8)]
    numbers: dict[str, int] = {"": 0}
    docs = [([numbers.setdefault(w, len(numbers)) for w in gated_toxicity.WORD.findall(t)], y) for t, y in rows]
    at = np.array([gated_toxicity.word_row(w) for w in numbers])
    flat, sizes = gated_toxicity.gram_rows(list(numbers))
    grams = np.split(flat, np.cumsum(sizes)[:-1])
    learner = gated_toxicity.Learner(1, 0.02)
    losses = [learner.learn(docs, at, grams) for _ in range(12)]
    assert losses[-1] < losses[0] and all(b < a + 0.05 for a, b in zip(losses, losses[1:]))


def test_all_windows_are_scored():
    for n in (0, 1, 39, 40, 41, 72, 73, 1000):
        found = gated_toxicity.windows(n)
        assert set(range(n)) == {i for s, e in found for i in range(s, e)} and found
        assert all(0 < e - s <= gated_toxicity.WINDOW or n == 0 for s, e in found)


@pytest.mark.parametrize("score", [ftrl_quality.quality_scores, gated_toxicity.toxicity_scores])
def test_hard_documents(spark, score):
    docs = with_clashes(hard_docs(spark))
    some = labels_of(spark, [(1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 0, None), (None, 1, 1), (8, 0, 1), (12, 1, 0), (12, 1, 0)])
    for labels in (some, some.filter("doc_id < 0"), some.filter("quality = 1 and toxic = 0")):
        rows = score(docs, labels).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        same = {r["score"] for r in rows if r["doc_id"] == 1}
        assert len(same) == 1
    assert score(empty_docs(spark), some).collect() == []


def test_quality_filter_keeps_columns(spark):
    docs = with_clashes(hard_docs(spark))
    labels = labels_of(spark, [(1, 1, 0)])
    kept = ftrl_quality.kept_by_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count()
