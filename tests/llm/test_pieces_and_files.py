"""Piece codec and token files against the libraries."""

from __future__ import annotations

import hashlib
import itertools
import struct
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bazaarspark.llm import piece_codec, token_files
from bazaarspark.llm.common import shared_folder
from tests.llm.helpers import empty_docs, hard_docs, rows_of, with_clashes

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
alphabet = st.text(alphabet="ab eorth.▁\n é漢🙂<>0x", max_size=60) | st.text(max_size=30)


@settings(max_examples=200, deadline=None)
@given(alphabet)
def test_agenda_equals_library(text):
    coder = piece_codec.merger(PIECES)
    ids = coder.encode([text])[0]
    assert ids == library.encode(text)
    assert coder.decode([*ids, coder.end]) == library.decode([*ids, coder.end])


@pytest.mark.parametrize("short", [0, 48])
def test_list_and_heap_agenda_agree(short, monkeypatch):
    monkeypatch.setattr(piece_codec, "SHORT", short)
    coder = piece_codec.Merger(PIECES)
    for text in ("internationalization" * 30, "a" * 200, " the  cat\n\nsat", "x" + " " * 50 + "y"):
        assert coder.encode([text])[0] == library.encode(text)


def test_new_segments_are_merged_together():
    coder = piece_codec.Merger(PIECES)
    text = " ".join("".join(chr(97 + (i // 26**k + 7 * k) % 26) for k in range(4)) + "ation"[: i % 6] for i in range(20_000))
    assert len(set(text.split())) == 20_000
    coder.encode(["what is imported late is imported now"])
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        ids = coder.encode([text])[0]
    finally:
        sys.setprofile(None)
    assert ids == library.encode(text)
    assert calls < 10_000  # less than one for two segments


def test_rows_and_heap_agree_on_segments_of_all_lengths(monkeypatch):
    letters = ["e", "th", "▁", "▁▁", "é", "漢", "🙂", "\x00", "\U0010ffff", "ing", "0", "\n"]
    segments = ["▁" + "".join(letters[(7 * i + k * k * (i % 5)) % 12] for k in range(i % 30)) for i in range(3000)]
    coder = piece_codec.Merger(PIECES)
    rows = coder.merged(segments)
    monkeypatch.setattr(piece_codec, "SHORT", 0)
    assert rows == coder.merged(segments)
    texts = ["", *segments, "", " ".join(segments), "  "]
    assert coder.encode(texts) == [library.encode(t) for t in texts]
    assert coder.encode([]) == []


@pytest.mark.parametrize("change", ["another id", "another boundary"])
def test_difference_from_library_stops(change, monkeypatch):
    coder = piece_codec.Merger(PIECES)
    plain = coder.merged

    def wrong(segments):
        found = plain(segments)
        if change == "another id":
            return [found[0][:-4] + np.int32(5).tobytes(), *found[1:]]
        return [found[0] + found[1][:4], found[1][4:], *found[2:]]

    monkeypatch.setattr(coder, "merged", wrong)
    with pytest.raises(RuntimeError, match="the library has"):
        coder.encode(["seven wizards mixing potions"])


def test_digests_of_hard_documents(spark):
    docs = with_clashes(hard_docs(spark))
    want = []
    for row in docs.collect():
        ids = [*library.encode(row["text"] or ""), library.eos_id()]
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((row["doc_id"], len(ids), sha, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert rows_of(piece_codec.piece_digests(docs, PIECES)) == sorted(want, key=repr)
    assert piece_codec.piece_digests(empty_docs(spark), PIECES).collect() == []
    back = piece_codec.round_trip(docs, PIECES)
    assert back.columns == docs.columns
    assert {r["text"] for r in back.collect()} == {library.decode(library.encode(r["text"] or "")) for r in docs.collect()}


def test_blocks_round_trip():
    rng = np.random.default_rng(3)
    for values in (
        np.zeros(0, np.uint32),
        np.zeros(5, np.uint32),
        rng.integers(0, 50_257, 1000).astype(np.uint32),
        np.array([7, 2**32 - 1, 0, 3] * 70, np.uint32),
        np.where(rng.random(5000) < 0.05, 2**31, rng.integers(0, 9, 5000)).astype(np.uint32),
    ):
        body, starts = token_files.packed(values)
        assert (token_files.unpacked(body, starts, len(values)) == values).all()
    few_bits, _ = token_files.packed(np.where(np.arange(1280) % 40 == 0, 2**20, 3).astype(np.uint32))
    assert len(few_bits) < 1280  # the outliers do not widen their blocks


@settings(max_examples=150, deadline=None)
@given(alphabet)
def test_cut_words_equal_whole_texts(text):
    whole = Tokenizer.from_file(BYTES)
    whole.encode_special_tokens = True
    got = np.frombuffer(token_files.byte_encoder(BYTES).encode([text])[0], "<u4").tolist()
    assert got == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file_ids", [50, 1 << 20])
def test_files_hold_the_documents(spark, file_ids):
    docs = with_clashes(hard_docs(spark))
    folder = shared_folder(spark, "tokens")
    token_files.write_tokens(docs, BYTES, folder, file_ids=file_ids)
    whole = Tokenizer.from_file(BYTES)
    order = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    ids = {i: [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 0] for i, r in enumerate(order)}
    stored = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: (r[0], r[1], r[2]))
    assert sorted((r["doc_id"], r["ids"]) for r in stored if r["doc_id"]) == sorted(
        (r["doc_id"], ids[i]) for i, r in enumerate(order) if r["doc_id"]
    )
    assert [r["doc_id"] for r in stored] == [r["doc_id"] for r in order]
    found = rows_of(token_files.token_digests(spark, folder))
    flat = list(itertools.chain.from_iterable(r["ids"] for r in stored))
    assert sum(r[2] for r in found) == len(flat)
    for _, start, n, crc in found:
        part = flat[start : start + n]
        assert crc == zlib.crc32(struct.pack(f"<{n}I", *part))
    none = shared_folder(spark, "tokens")
    token_files.write_tokens(empty_docs(spark), BYTES, none)
    assert token_files.token_digests(spark, none).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|", "|>", "a", " ", "\n", "wizards", ".", "é"]), max_size=12).map("".join))
def test_strings_of_added_tokens_equal_library(text):
    got = np.frombuffer(token_files.byte_encoder(BYTES).encode([text])[0], "<u4").tolist()
    assert got == Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids


def test_files_of_texts_with_added_tokens(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "plain words"), (4, "wizards<|endoftext|>\nmix <|endoftext|")]
    folder = shared_folder(spark, "tokens")
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), BYTES, folder)
    library, want, start = Tokenizer.from_file(BYTES), [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        want.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert rows_of(token_files.token_digests(spark, folder)) == want
