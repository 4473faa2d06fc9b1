"""Passages of short units, against a brute force of its own that knows no digests."""

from __future__ import annotations

import random
import re

import pytest

from bazaarspark.llm import unit_dedup
from tests.llm.helpers import DOCS, sentence

LEAST, MOST = 5, 20


def cut(text: str) -> list[tuple[int, int, tuple[str, ...]]]:
    """(start, end, words) of sentences: at line feeds, and at white space behind a closing sign."""
    out, start, at = [], 0, 0
    while at < len(text):
        at += 1
        feed = text[at - 1] == "\n"
        blank = text[at - 1] in " \t" and at > 1 and re.search(r"[.!?|*%&$#][ \t]*$", text[:at])
        if at == len(text) or ((feed or blank) and text[at] not in (" \t\n" if feed else " \t")):
            words = tuple(re.findall(r"\w+", text[start:at].lower()))
            if words:
                out.append((start, at, words))
            elif out:
                out[-1] = (out[-1][0], at, out[-1][2])
            start = at
    return out


def brute_spans(texts: list[str]) -> list[list[tuple[int, int]]]:
    """Spans of the units that repeat an earlier sequence of enough words, or stand in a run of long repeats."""
    docs = [cut(t) for t in texts]
    every = [(d, k) for d, found in enumerate(docs) for k in range(len(found))]
    words = [docs[d][k][2] for d, k in every]
    gone, seen, repeated = set(), set(), []
    for q, (d, _) in enumerate(every):
        repeated.append(words[q] in seen)
        seen.add(words[q])
        for p in range(q):
            n = 0
            while q + n < len(every) and every[q + n][0] == d and every[p + n][0] == every[p][0] and words[p + n] == words[q + n]:
                n += 1
            if n > 1 and sum(map(len, words[q : q + n])) >= MOST:
                gone.update(range(q, q + n))
    q = 0
    while q < len(every):
        end = q
        while end < len(every) and repeated[end] and every[end][0] == every[q][0]:
            end += 1
        if sum(len(w) for w in words[q:end] if len(w) >= LEAST) >= MOST:
            gone.update(range(q, end))
        q = max(end, q + 1)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for q in sorted(gone):
        d, k = every[q]
        start, end, _ = docs[d][k]
        if out[d] and out[d][-1][1] == start:
            start = out[d].pop()[0]
        out[d].append((start, end))
    return out


def spans(spark, texts: list[str]) -> list[list[tuple[int, int]]]:
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS).repartition(3)
    found = {r["doc_id"]: [(x["start"], x["end"]) for x in r["removed"]] for r in unit_dedup.unit_spans(docs).collect()}
    return [found[i] for i in range(len(texts))]


def test_long_runs_of_short_units_go(spark):
    table = " | ".join(f"cell {i}" for i in range(40))
    verse = "\n".join(sentence(i, 4)[:-1] for i in range(12))
    stray = "Yes. No. " * 4
    texts = [
        f"{sentence(1, 12)}\n{table}",
        f"{sentence(2, 12)}\n{table} | more",
        f"Verse\n{verse}\n{sentence(3, 12)}",
        f"{verse}\nother words",
        "WORD!! " * 100,
        stray.strip(),
        "No. Yes. Maybe. Yes. No. Never. Yes. Fine. No. Good. Yes.",
        "No. Fine. Yes. Never. Good. Maybe. No. Yes. Yes. Fine. Never. No. Good. Maybe. Fine. No. Yes. Good. Never. Fine. No.",
    ]
    got = spans(spark, texts)
    assert got == brute_spans(texts)
    left = [unit_dedup.without(t, s) for t, s in zip(texts, got)]
    assert left[1] == f"{sentence(2, 12)}\nmore"
    assert left[3] == "other words"
    assert left[4] == "WORD!! "
    assert left[5:] == texts[5:]  # short sentences in another order are no passage


@pytest.mark.parametrize("seed", [1, 2])
def test_random_short_units_against_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = []
    for _ in range(8):
        parts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9]))) for _ in range(rng.randint(6, 24))]
        passages.append([p + rng.choice([". ", "\n", " | ", "!! "]) for p in parts])
    texts = []
    for _ in range(80):
        units = []
        for _ in range(rng.randint(0, 4)):
            some = rng.choice(passages)
            first = rng.randrange(len(some))
            units += some[first : first + rng.randint(2, 24)]
            units += [" ".join(rng.choice("ijklmnop") for _ in range(rng.randint(1, 7))) + ". " for _ in range(rng.randint(0, 3))]
        texts.append("".join(units))
    want = brute_spans(texts)
    assert sum(map(len, want)) > 20
    assert spans(spark, texts) == want
