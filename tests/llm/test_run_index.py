"""Repeated byte strings against brute force over all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarspark.llm import run_index_dedup as module
from tests.llm.helpers import empty_docs, hard_docs, rows_of, sentence, with_clashes


def covered(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Runs of bytes of each text that repeated windows cover, window by window."""
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        edges = [i for i in range(len(t) + 1) if (i > 0 and gone[i - 1]) != (i < len(t) and gone[i])]
        found.append(list(zip(edges[::2], edges[1::2])))
    return found


def plainly(rows, length: int):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (doc_id, _), t, spans in zip(rows, texts, covered(texts, length)):
        at, kept = 0, b""
        for s, e in spans:
            kept, at = kept + t[at:s], e
        kept += t[at:]
        out.append((doc_id, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


few = st.binary(max_size=60).map(lambda b: bytes(97 + x % 3 for x in b))


@settings(max_examples=150, deadline=None)
@given(st.lists(few.filter(len), min_size=1, max_size=6), st.integers(4, 9))
def test_index_finds_all_repeats(strings, length):
    assert module.RunIndex(strings, length).repeated() == covered(strings, length)


def test_index_is_a_transform_in_runs():
    strings = [b"banana bandana", b"banana bandana", b"cabana"]
    index = module.RunIndex(strings, 4)
    n = sum(len(s) + 1 for s in strings)
    assert index.run_lengths.sum() == n and len(index.run_lengths) < n
    assert (index.run_symbols[1:] != index.run_symbols[:-1]).all()
    text = b"\0".join(strings) + b"\0"
    longest = index.matching_statistics()
    for i in range(n - 4):
        window = text[i : i + 4]
        assert (longest[i] >= 4) == (b"\0" not in window and sum(text[j : j + 4] == window for j in range(n)) > 1)
    # Copies hardly add runs.
    copies = module.RunIndex([sentence(1, 40).encode()] * 20, 50)
    assert len(copies.run_lengths) < 2.5 * len(sentence(1, 40))


@settings(max_examples=150, deadline=None)
@given(st.lists(few, max_size=6))
def test_segments_hold_every_window_once_and_no_two_equal(texts):
    length, anchor = 10, 4
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    if len(raw) < length:
        return
    rows = list(zip(*(x.tolist() for x in module.segments(raw, offsets, length, anchor))))
    windows = [(t, a + i - offsets[t]) for t, a, n, _ in rows for i in range(n)]
    assert sorted(windows) == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - length + 1)]
    by_window: dict = {}
    for t, a, n, h in rows:
        inside = [bytes(raw[a + i : a + i + length]) for i in range(n)]
        assert len(set(inside)) == n
        for w in inside:
            assert by_window.setdefault(w, h) == h


def repetitive(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    passages = [sentence(s, rng.randint(3, 9)) for s in range(4)]
    rows: list[tuple] = [(None, None), (0, ""), (1, "ab" * 300), (2, "short"), (3, "a" * 500), (4, "é漢" * 90)]
    for i in range(5, 45):
        parts = [rng.choice(passages) if rng.random() < 0.5 else sentence(100 + rng.randrange(60), rng.randint(1, 9)) for _ in range(6)]
        rows.append((i, " ".join(parts)))
    return rows + [rows[10], (99, rows[11][1])]


@pytest.mark.parametrize("crowd", [0, 2, 1000])
def test_documents_equal_brute_force(spark, crowd, monkeypatch):
    monkeypatch.setattr(module, "CROWD", crowd)
    monkeypatch.setattr(module, "SHARD", 2_000)
    rows = repetitive(crowd)
    docs = with_clashes(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    length = 40
    keyed = module.keyed(docs.repartition(3))
    cut = {bytes(r["tid"]): r for r in module.cut_texts(keyed, length, 8, crowd).collect()}
    texts = [(t or "").encode() for _, t in rows]
    want = covered(texts, length)
    for t, spans in zip(texts, want):
        found = cut.get(hashlib.sha256(t).digest())
        assert (found and [(x["s"], x["e"]) for x in found["spans"]] or []) == spans
    assert any(want)
    assert rows_of(module.repeat_digests(docs, 80)) == plainly(rows, 80)


def test_hard_documents(spark):
    docs = with_clashes(hard_docs(spark))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(module.repeat_digests(docs)) == plainly(rows, module.LENGTH)
    assert module.repeat_digests(empty_docs(spark)).collect() == []
    kept = {r["doc_id"]: r for r in module.without_long_repeats(docs).collect()}
    assert bytes(kept[8]["kept"]) == b"one" and bytes(kept[1]["kept"]) == b"" and kept[4]["removed"] == []


def test_text_of_many_parts(spark):
    long = " ".join(sentence(s, 500) for s in range(700))
    rows = [(1, long), (2, long[2_000_100:2_001_000] + " else"), (3, sentence(9_999, 80))]
    assert len(long) > 2 * module.SHARD
    found = {r[0]: r for r in module.repeat_digests(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [found[i]["n_removed"] for i in (1, 2, 3)] == [900, 900, 0]
