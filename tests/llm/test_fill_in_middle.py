"""Fill-in-middle against a plain restatement with a regular expression."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarspark.llm import wavelet_fim
from tests.llm.helpers import empty_docs, hard_docs, rows_of, with_clashes

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def plainly(key, text):
    """(n, form, prefix_chars, middle_chars, output) by the rule."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


texts = st.text(alphabet="abZ <>PSM.\né漢🙂0", max_size=40) | st.sampled_from(["", "<P>", "a" * 300, "<<S<S>", "<", ">"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-(1 << 63), (1 << 63) - 1), texts), max_size=20))
def test_slices_equal_the_rule(rows):
    keys, given_texts = [k for k, _ in rows], [t for _, t in rows]
    found = list(wavelet_fim.rearranged(keys, given_texts, "1", 90, 20))
    assert found == [plainly(k, t) for k, t in rows]
    assert [wavelet_fim.restored(out, form) for _, form, _, _, out in found] == given_texts


def test_ranks_count_symbols():
    rng = np.random.default_rng(5)
    for n, bits in ((0, 1), (1, 2), (63, 2), (64, 3), (1000, 4)):
        symbols = rng.integers(0, 1 << bits, n).astype(np.uint8)
        matrix = wavelet_fim.WaveletMatrix(symbols, bits)
        for s in range(1 << bits):
            want = np.concatenate([[0], np.cumsum(symbols == s)])
            assert (matrix.rank(s, np.arange(n + 1)) == want).all()


def test_hard_documents(spark):
    docs = with_clashes(hard_docs(spark))
    odd = spark.createDataFrame([(20, "x<P>y"), (21, "a <M"), (22, "🙂" * 9)], "doc_id bigint, text string")
    for table in (docs, odd):
        rows = table.collect()
        want = [(r["doc_id"], *plainly(r["doc_id"], r["text"])) for r in rows]
        assert rows_of(wavelet_fim.fill_in_middle(table)) == sorted(want, key=repr)
        digests = [(*w[:5], sha(w[5]), sha(r["text"] or "")) for w, r in zip(want, rows)]
        assert rows_of(wavelet_fim.fim_digests(table)) == sorted(digests, key=repr)
    assert wavelet_fim.fim_digests(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("fim_rate, spm_rate, forms", [(0, 50, {"plain"}), (100, 0, {"psm"}), (100, 100, {"spm"})])
def test_rates(spark, fim_rate, spm_rate, forms):
    docs = hard_docs(spark).filter("text <> ''")
    found = wavelet_fim.fill_in_middle(docs, "7", fim_rate, spm_rate).collect()
    assert {r["form"] for r in found} == forms
