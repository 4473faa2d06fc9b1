"""SentencePiece encoding and decoding for merge-type vocabularies.

`Merger` holds an agenda of adjacent symbol pairs ordered by piece score (ties: leftmost). A pair is merged when its
concatenation is a piece; its neighbours then enter the agenda. No piece of such a vocabulary holds a space mark after
another character, so no merge crosses the point before a run of space marks: the text is cut there, and equal
segments are merged once per worker. The different segments of an Arrow batch are looked up once, and new ones of equal
length are merged together: a row of symbols and an agenda for each, one merge in every row at a time. New segments are
encoded by the sentencepiece library as well; any difference stops the job. Decoding maps ids to pieces, drops the mark
that encoding put in front, and joins bytes.

Defined results: a null or empty text has the end id alone and decodes to the empty text; texts of any length are
encoded whole; every input row gives one row, so repeated rows stay; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bazaarspark.llm.common import Remembered, arrow, kept, no_garbage, some_bytes, texts_of

MARK = "▁"
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
REMEMBERED = 400_000  # distinct segments a worker keeps
SHORT = 48  # characters up to which scanning a row of scores beats a heap
NONE = float("inf")


class Merger:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, size = self.library, self.library.vocab_size()
        names = [lib.id_to_piece(i) for i in range(size)]
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if lib.is_byte(i)}
        plain = [i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        self.ids = {names[i]: i for i in plain}
        self.scores = {names[i]: -lib.get_score(i) for i in plain}
        self.unknown, self.end = lib.unk_id(), lib.eos_id()
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece of this vocabulary holds a space mark after another character")
        self.surface: list[bytes | None] = [None] * size
        for i in plain:
            self.surface[i] = names[i].replace(MARK, " ").encode()
        for b, i in self.bytes.items():
            self.surface[i] = bytes([b])
        self.names, self.decimals = names, [str(i) for i in range(size)]
        self.row_tables(size)
        self.known = Remembered(remembered)

    def row_tables(self, size: int) -> None:
        """Symbols as numbers: a piece is its id, another character comes after the ids; the last number is the end of a row."""
        self.of_character = np.arange(size, size + sys.maxunicode + 2)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of_character[ord(p)] = i
        number = lambda s: self.ids[s] if s in self.ids else size + ord(s) if len(s) == 1 else None
        pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = number(p[:k]), number(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        keys = np.array([*pairs, np.iinfo(np.int64).max])
        order = np.argsort(keys)
        self.pair_keys, self.pair_ids = keys[order], np.array([*pairs.values(), -1])[order]
        self.row_scores = np.full(size + 1, NONE)  # the last one stands for -1, no piece
        for p, i in self.ids.items():
            self.row_scores[i] = self.scores[p]

    def merged(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment (32-bit numbers) by the agenda: rows of scores for short ones, a heap for a long one."""
        found = [b""] * len(segments)
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            if length <= SHORT:
                for rows, ids in self.rows_merged([segments[i] for i in at.tolist()]):
                    for i, x in zip(at[rows].tolist(), ids):
                        found[i] = x
            else:
                for i in at.tolist():
                    found[i] = self.packed(self.heap_merged(segments[i]))
        return found

    def packed(self, symbols: list[str]) -> bytes:
        try:
            ids = [self.ids[s] for s in symbols]
        except KeyError:
            ids = self.fallback(symbols)
        return np.array(ids, np.int32).tobytes()

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        keys = a << 32 | b
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ids[at], -1)

    def rows_merged(self, segments: list[str]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """(numbers, ids) of segments of one length: in each round the best pair of every row is merged."""
        size = len(self.names)
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).reshape(len(segments), -1)
        symbols = np.pad(self.of_character[points], ((0, 0), (0, 1)), constant_values=self.of_character[-1])
        pairs = self.joined(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(len(segments))
        while True:
            scores = self.row_scores[pairs]
            at = scores.argmin(axis=1)  # the leftmost of equal scores
            more = scores[np.arange(len(rows)), at] < NONE
            done = symbols[~more, :-1]
            raw, width = done.astype(np.int32).tobytes(), 4 * done.shape[1]
            ids = [raw[k : k + width] for k in range(0, len(raw), width)]
            for k in np.flatnonzero((done >= size).any(axis=1)).tolist():
                ids[k] = self.packed([self.names[x] if x < size else chr(x - size) for x in done[k].tolist()])
            yield rows[~more], ids
            if not more.any():
                return
            rows, at, symbols, pairs = rows[more], at[more], symbols[more], pairs[more]
            each = np.arange(len(rows))
            symbols[each, at] = pairs[each, at]
            symbols, pairs = without(symbols, at + 1), without(pairs, at + 1)
            pairs[each, at] = self.joined(symbols[each, at], symbols[each, at + 1])
            each, at = each[at > 0], at[at > 0]
            pairs[each, at - 1] = self.joined(symbols[each, at - 1], symbols[each, at])

    def heap_merged(self, segment: str) -> list[str]:
        symbols = list(segment)
        n = len(symbols)
        scores = self.scores.get
        agenda = [(x, i, i + 1, 2) for i in range(n - 1) if (x := scores(symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            a, b = symbols[i], symbols[j]
            # Stale entries: a side was merged away, or has grown since.
            if not a or not b or len(a) + len(b) != size or after[i] != j:
                continue
            symbols[i], symbols[j] = a + b, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for left, right in ((i, k), (before[i], i)):
                if left >= 0 and right < n:
                    both = symbols[left] + symbols[right]
                    score = scores(both)
                    if score is not None:
                        heapq.heappush(agenda, (score, left, right, len(both)))
        return [s for s in symbols if s]

    def fallback(self, symbols: list[str]) -> list[int]:
        """Ids of symbols some of which are no pieces: their bytes, or one unknown id for a run of them."""
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in s.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def segments(self, text: str) -> list[str]:
        """The text with its leading mark, cut before runs of marks; the first mark of each segment is left out."""
        if not text:
            return []
        spaced = text.replace(MARK, " ")
        if "  " in spaced or spaced[0] == " " or spaced[-1] == " ":
            return [s[1:] for s in SEGMENT.findall(MARK + spaced.replace(" ", MARK))]
        return spaced.split(" ")

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts in a row, and where each text starts and ends; what is new is held against the library."""
        known = self.known
        known.make_room()
        with no_garbage():
            cut = [self.segments(t) for t in texts]
            ends = np.cumsum([0, *map(len, cut)])
            flat = list(itertools.chain.from_iterable(cut))
            used = pa.array(flat, pa.large_string()).dictionary_encode().indices.to_numpy()
            place = np.zeros(used.max(initial=-1) + 1, np.int64)
            place[used] = np.arange(len(used))
            different = [flat[i] for i in place.tolist()]
            del cut, flat
            new = known.missing([different])
            merged = self.merged([MARK + s for s in new])
            self.compare(new, merged)
            known.update(zip(new, merged))
            del new, merged
        ids = [known[s] for s in different]
        # Of each different segment its ids, then those of all segments in their order.
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        numbers = np.frombuffer(b"".join(ids), np.int32)
        del different, ids
        before = np.concatenate([[0], np.cumsum(counts[used])])
        shift = (np.cumsum(counts) - counts)[used] - before[:-1]
        places = np.repeat(shift, counts[used])
        places += np.arange(len(places))
        return numbers[places], before[ends]

    def compare(self, segments: list[str], merged: list[bytes]) -> None:
        # The library puts a mark before a text, unless that text is empty.
        texts = [s for s in segments if s]
        ours = [mine for s, mine in zip(segments, merged) if s]
        theirs = self.library.encode(texts, num_threads=1) if texts else []
        counts = np.fromiter(map(len, theirs), np.int64, len(theirs))
        sizes = np.fromiter(map(len, ours), np.int64, len(ours))
        flat = np.fromiter(itertools.chain.from_iterable(theirs), np.int32, int(counts.sum()))
        if (sizes == 4 * counts).all() and flat.tobytes() == b"".join(ours):
            return
        for text, mine, lib in zip(texts, ours, theirs):
            ids = np.frombuffer(mine, np.int32).tolist()
            if ids != lib:
                raise RuntimeError(f"segment {MARK + text!r}: {ids}, the library has {lib}")

    def each(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each whole text; a list lives until the next one."""
        flat, ends = self.encoded(texts)
        return (flat[a:b].tolist() for a, b in itertools.pairwise(ends.tolist()))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return list(self.each(texts))

    def decode(self, ids: list[int]) -> str:
        surface = self.surface
        raw = b"".join([surface[i] or b"" for i in ids])
        if raw[:1] == b" " and ids and surface[next((i for i in ids if surface[i] is not None), 0)][:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def without(matrix: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The matrix without one column of its own in each row."""
    stay = np.ones(matrix.shape, bool)
    stay[np.arange(len(matrix)), columns] = False
    return matrix[stay].reshape(len(matrix), -1)


def merger(path: str, remembered: int = REMEMBERED) -> Merger:
    return kept(Merger, path, remembered)


def with_pieces(
    docs: DataFrame, path: str, end_id: bool = True, key: str = "doc_id", remembered: int = REMEMBERED
) -> DataFrame:
    """(key, ids, decoded) of every whole text: the ids with the end id, and the text those ids decode to.

    A worker remembers the ids of `remembered` segments: less memory for more work.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        coder = merger(path, remembered)
        end = [coder.end] if end_id else []
        for batch in some_bytes(batches):
            flat, ends = coder.encoded(texts_of(batch))
            flat = np.insert(flat, np.repeat(ends[1:], len(end)), end * (len(ends) - 1))
            ends = (ends + len(end) * np.arange(len(ends))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            texts = pa.array([coder.decode(flat[a:b].tolist()) for a, b in itertools.pairwise(ends.tolist())], pa.string())
            yield pa.record_batch([batch.column(key), lists, texts], [key, "ids", "decoded"])

    return arrow(docs.select(key, "text"), work, f"{key} {kind}, ids array<int>, decoded string")


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, digested where it is encoded."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        coder = merger(path)
        for batch in some_bytes(batches):
            counts, ids_sha, text_sha = [], [], []
            for ids in coder.each(texts_of(batch)):
                ids.append(coder.end)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join([coder.decimals[i] for i in ids]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return arrow(docs.select("doc_id", "text"), work, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """The documents with `text` as it decodes from its pieces, and no other change of columns."""
    names = docs.columns
    at = names.index("text")

    def work(batches):
        coder = merger(path)
        for batch in some_bytes(batches):
            columns = list(batch.columns)
            columns[at] = pa.array([coder.decode(x) for x in coder.each(texts_of(batch))], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return arrow(docs, work, docs.schema)
