"""Token ids in binary files of patched frame-of-reference blocks.

A file holds whole documents in ascending key order: a header, the documents' keys and lengths, the index of block
starts, then the blocks. A block holds `BLOCK` ids as differences to its smallest id, packed with the width that fits
`PERCENTILE` of them; the others, the outliers, stand in an exception list of positions and values.

Files are written by Spark's own writer (one record for each file, so its commit protocol and any file system apply; a
line feed ends each file) and read back with the `binaryFile` source. A file's place in the whole is (partition,
segment); the starts of all documents follow from the files' totals, so no pass needs all lengths in one place.

Defined results: null and empty texts have the end id alone; null keys come first; documents with the same key are
ordered by their text; repeated rows stay; a document is never cut, so a very long one makes one long file; other
columns are not read; an empty table makes an empty folder and no rows.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, kept, no_garbage, some_bytes, texts_of, written

BLOCK = 128
PERCENTILE = 0.9
FILE_IDS = 1 << 20  # ids after which a file is closed
MAGIC = b"PFR1"
HEADER = struct.Struct("<4sIIQII")  # magic, partition, segment, ids, documents, blocks
REMEMBERED = 1_000_000  # distinct words a worker keeps, about
SLICE = 8 << 20  # bytes of text that are cut together
MARKS = ".,;:!?*%&$#|/()[]{}<>+-=~\""  # signs that no pattern joins to the letters before them

# What the quick cut cannot handle: other white space, white space in runs or at an end, and the cut mark itself.
ODD = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\x01]")
RUNS = ("  ", " \n", "\n ", "\n\n")
ENDING = f"(?P<marks>[{re.escape(MARKS)}]+)$"
SPACES = (" ", "\n", "")  # of a first or last character; an empty text has none


class ByteEncoder:
    """Whole texts to ids with the tokenizers library.

    A byte-level pre-tokenizer never joins a word to the space that follows it, so a text is cut before single spaces
    and around single line feeds; the library encodes each distinct word of a worker once. Other texts, those that hold
    the string of an added token (the library gives its id), and other kinds of tokenizers, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        self.cuts = (
            spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
        )
        added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
        self.whole = (*RUNS, *added)
        # A word that is cut off could be part of an added token with white space.
        self.cuts = self.cuts and not any(re.search(r"\s", t) for t in added)
        feed = self.library.encode("\n", add_special_tokens=False).ids
        self.cuts = self.cuts and len(feed) == 1
        self.feed = feed[0]
        self.known, self.remembered = KnownWords(["\n", ""], [feed, []]), REMEMBERED

    def library_ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [array("I", e.ids).tobytes() for e in found]

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cut words in a row, and how many each word has: many words as one text, which costs less.

        A line feed stands before each word. No word holds one or is ever joined to one, so its id marks the words.
        """
        parts = [np.zeros(0, np.uint32)]
        for i in range(0, len(words), 128):  # the library is quickest with short texts like these
            found = self.library.encode_batch_fast(["\n" + "\n".join(words[i : i + 128])], add_special_tokens=False)
            parts.append(np.array(found[0].ids, np.uint32))
        ids = np.concatenate(parts)
        marks = np.flatnonzero(ids == self.feed)
        return ids[ids != self.feed], np.diff(np.append(marks, len(ids))) - 1

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        ids, lengths = self.encoded(texts)
        ends = np.cumsum(lengths).tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]

    def quick(self, text: str) -> bool:
        """Whether the text can be cut into words."""
        if not self.cuts or ODD.search(text) or text[:1] in SPACES or text[-1:] in SPACES:
            return not text and self.cuts
        return not any(x in text for x in self.whole)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        with no_garbage():
            quick = np.fromiter(map(self.quick, texts), bool, len(texts))
            ids, counts = self.cut_ids([t for t, q in zip(texts, quick) if q])
            if quick.all():
                return ids, counts
            others = self.library_ids([t for t, q in zip(texts, quick) if not q])
        lengths = np.zeros(len(texts), np.int64)
        lengths[quick], lengths[~quick] = counts, [len(x) // 4 for x in others]
        out, cut = np.empty(int(lengths.sum()), "<u4"), np.repeat(quick, lengths)
        out[cut], out[~cut] = ids, np.frombuffer(b"".join(others), "<u4")
        return out, lengths

    def cut_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `encoded`, of texts that are cut into words; Arrow cuts them and numbers the different words."""
        cut = pc.replace_substring(pa.array(texts, pa.string()), " ", "\x01 ")
        cut = pc.split_pattern(pc.replace_substring(cut, "\n", "\x01\n\x01"), "\x01")
        words = cut.flatten().dictionary_encode()
        known = self.known
        known.make_room(self.remembered)
        at = self.numbers(words.dictionary)
        known.recent = at
        ids, counts = known.ids(at[words.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(counts)])[cut.offsets.to_numpy()]
        return ids, np.diff(ends)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers in the table of known words of different words; new words are learnt."""
        found = pc.index_in(words, value_set=self.known.words)
        new = pc.is_null(found).to_numpy(zero_copy_only=False)
        at = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        if new.any():
            at[new] = self.learnt(words.filter(pa.array(new)))
        return at

    def learnt(self, words: pa.Array) -> np.ndarray:
        # Marks behind a letter or digit are cut off as well: the pre-tokenizer always does.
        base = pc.utf8_rtrim(words, MARKS)
        ended = pc.and_(
            pc.less(pc.binary_length(base), pc.binary_length(words)), pc.utf8_is_alnum(pc.utf8_slice_codeunits(base, -1))
        ).to_numpy(zero_copy_only=False)
        at = np.zeros(len(words), np.int64)
        whole = words.filter(pa.array(~ended))
        at[~ended] = self.known.add(whole, *self.word_ids(whole.to_pylist()))
        if ended.any():
            words, base = words.filter(pa.array(ended)), base.filter(pa.array(ended))
            marks = pc.struct_field(pc.extract_regex(words, ENDING), 0)
            parts = pa.concat_arrays([base, marks]).dictionary_encode()
            both = self.numbers(parts.dictionary)[parts.indices.to_numpy()].reshape(2, -1).T
            ids, counts = self.known.ids(both.reshape(-1))
            at[ended] = self.known.add(words, ids, counts.reshape(-1, 2).sum(axis=1))
        return at


class KnownWords:
    """Words with their ids, in Arrow and numpy arrays; a word is known by its number."""

    def __init__(self, words: list[str], ids: list[list[int]]):
        self.words = pa.array(words, pa.string())
        self.values = np.array([i for x in ids for i in x], np.uint32)
        self.ends = np.cumsum([0, *map(len, ids)])
        self.always = len(words)
        self.recent = np.arange(0)  # of the words used last

    def add(self, words: pa.Array, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The numbers of words that are added with `counts` of the ids each."""
        first = len(self.words)
        self.words = pa.concat_arrays([self.words, words])
        self.values = np.concatenate([self.values, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        return np.arange(first, first + len(words))

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words with these numbers in a row, and how many each has."""
        lists = pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(self.values))
        return lists.take(pa.array(at)).flatten().to_numpy(), (self.ends[1:] - self.ends[:-1])[at]

    def make_room(self, most: int) -> None:
        """If more than `most` words are known, only those of the last texts stay."""
        if len(self.words) > most:
            kept = np.union1d(np.arange(self.always), self.recent)
            self.values, counts = self.ids(kept)
            self.words = self.words.take(pa.array(kept))
            self.ends = np.concatenate([[0], np.cumsum(counts)])
            self.recent = np.arange(len(kept))


def byte_encoder(path: str) -> ByteEncoder:
    return kept(ByteEncoder, path)


def packed(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of the ids, and where each of them starts."""
    n_blocks = -(-len(values) // BLOCK)
    if not n_blocks:
        return b"", np.zeros(0, "<u4")
    padded = np.full(n_blocks * BLOCK, values[-1], np.uint32)
    padded[: len(values)] = values
    rows = padded.reshape(n_blocks, BLOCK)
    least = rows.min(axis=1)
    rows = rows - least[:, None]
    kth = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = bit_length(np.partition(rows, kth, axis=1)[:, kth])
    outlier = rows >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    exceptions = outlier.sum(axis=1)
    size = 6 + 5 * exceptions + width.astype(np.int64) * (BLOCK // 8)
    starts = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    # A block: smallest id, width, number of exceptions; their positions; their values; the packed values.
    out[starts[:, None] + np.arange(4)] = as_bytes(least)
    out[starts + 4], out[starts + 5] = width, exceptions
    block, position = np.nonzero(outlier)
    rank = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
    out[starts[block] + 6 + rank] = position
    values_at = starts[block] + 6 + exceptions[block] + 4 * rank
    out[values_at[:, None] + np.arange(4)] = as_bytes(rows[block, position])
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            low = as_bytes(rows[at].reshape(-1)).reshape(len(at), BLOCK, 4)[:, :, : (int(w) + 7) // 8]
            bits = np.unpackbits(low, axis=2, bitorder="little")[:, :, :w]
            body = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")
            out[(starts + 6 + 5 * exceptions)[at][:, None] + np.arange(body.shape[1])] = body
    return out.tobytes(), starts.astype("<u4")


def as_bytes(values: np.ndarray) -> np.ndarray:
    """Little-endian bytes of unsigned 32-bit numbers, four in a row."""
    return np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)


def bit_length(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.uint8)


def unpacked(body: bytes, starts: np.ndarray, n: int) -> np.ndarray:
    """The ids of all blocks; blocks of one width are unpacked together."""
    raw = np.frombuffer(body, np.uint8)
    starts = starts.astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    if not len(starts):
        return out.reshape(-1)
    head = raw[starts[:, None] + np.arange(6)]
    least = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0]
    width, exceptions = head[:, 4], head[:, 5].astype(np.int64)
    packed_at = starts + 6 + 5 * exceptions
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            # A value lies within the five bytes from the one its first bit is in.
            bit = np.arange(BLOCK) * int(w)
            rows = np.zeros((len(at), BLOCK * int(w) // 8 + 4), np.uint8)
            rows[:, :-4] = raw[packed_at[at][:, None] + np.arange(BLOCK * int(w) // 8)]
            values = rows[:, bit >> 3].astype(np.uint64)
            for k in range(1, 2 if w <= 9 else 3 if w <= 17 else 5):
                values |= rows[:, (bit >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
            out[at] = (values >> (bit & 7).astype(np.uint64)) & np.uint64((1 << int(w)) - 1)
    block = np.repeat(np.arange(len(starts)), exceptions)
    rank = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
    values_at = starts[block] + 6 + exceptions[block] + 4 * rank
    values = np.ascontiguousarray(raw[values_at[:, None] + np.arange(4)]).view("<u4")[:, 0]
    out[block, raw[starts[block] + 6 + rank]] = values
    return (out + least[:, None]).reshape(-1)[:n]


def file_of(partition: int, segment: int, keys: list, lengths: np.ndarray, values: np.ndarray) -> bytes:
    body, starts = packed(values)
    numbers = np.array([0 if k is None else k for k in keys], "<i8")
    nulls = np.array([k is None for k in keys], np.uint8)
    head = HEADER.pack(MAGIC, partition, segment, len(values), len(keys), len(starts))
    return b"".join([head, numbers.tobytes(), nulls.tobytes(), lengths.astype("<u4").tobytes(), starts.tobytes(), body])


def parsed(content: bytes):
    """(partition, segment, keys, lengths, ids) of a file."""
    magic, partition, segment, n, docs, blocks = HEADER.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEADER.size
    numbers = np.frombuffer(content, "<i8", docs, at)
    nulls = np.frombuffer(content, np.uint8, docs, at + 8 * docs)
    lengths = np.frombuffer(content, "<u4", docs, at + 9 * docs)
    starts = np.frombuffer(content, "<u4", blocks, at + 13 * docs)
    ids = unpacked(content[at + 13 * docs + 4 * blocks :], starts, n)
    keys = [None if z else int(k) for k, z in zip(numbers, nulls)]
    return partition, segment, keys, lengths, ids


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end: int = 0, file_ids: int = FILE_IDS) -> None:
    """Encode every whole text and write the files, in ascending doc_id order, into a new folder."""

    def work(batches):
        coder, partition, segment = byte_encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, lengths, values, held = [], [], [], 0

        def closed():
            file = file_of(partition, segment, keys, np.concatenate(lengths), np.concatenate(values))
            return pa.record_batch([pa.array([file])], ["value"])

        for batch in some_bytes(batches, most=SLICE):
            names = batch.column("doc_id").to_pylist()
            ids, counts = coder.encoded(texts_of(batch))
            ids, counts = np.insert(ids, np.cumsum(counts), end), counts + 1
            ends, done, at = np.cumsum(counts), 0, 0  # documents and ids that are in a file or held
            while done < len(names):
                # A file ends with the document that fills it.
                full = int(np.searchsorted(ends, at + file_ids - held))
                last = min(full + 1, len(names))
                stop = int(ends[last - 1])
                keys += names[done:last]
                lengths.append(counts[done:last])
                values.append(ids[at:stop])
                held, done, at = held + stop - at, last, stop
                if held >= file_ids:
                    yield closed()
                    segment, keys, lengths, values, held = segment + 1, [], [], [], 0
        if keys:
            yield closed()

    order = ("doc_id", "tie", "text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions(*order)
    files = arrow(ordered.select("doc_id", "text"), work, "value binary")
    # The text writer writes the bytes of a value as they are.
    files.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(partition, segment, position, doc_id, ids) of every document in the files."""
    schema = "partition int, segment int, position int, doc_id bigint, ids array<int>"

    def work(batches):
        for batch in batches:
            for content in batch.column("content"):
                partition, segment, keys, lengths, ids = parsed(content.as_buffer().to_pybytes())
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                n = len(keys)
                yield pa.record_batch(
                    [
                        pa.array([partition] * n, pa.int32()),
                        pa.array([segment] * n, pa.int32()),
                        pa.array(range(n), pa.int32()),
                        pa.array(keys, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))),
                    ],
                    ["partition", "segment", "position", "doc_id", "ids"],
                )

    return arrow(spark.read.format("binaryFile").load(folder).select("content"), work, schema)


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, all from the files."""
    schema = "partition int, segment int, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"

    def work(batches):
        for batch in batches:
            for content in batch.column("content"):
                partition, segment, keys, lengths, ids = parsed(content.as_buffer().to_pybytes())
                ends = np.cumsum(lengths.astype(np.int64))
                raw, n = ids.astype("<u4"), len(keys)
                crc = [zlib.crc32(raw[e - m : e]) for e, m in zip(ends, lengths.astype(np.int64))]
                yield pa.record_batch(
                    [
                        pa.array([partition] * n, pa.int32()),
                        pa.array([segment] * n, pa.int32()),
                        pa.array(keys, pa.int64()),
                        pa.array(ends - lengths),
                        pa.array(lengths.astype(np.int64)),
                        pa.array(crc, pa.int64()),
                    ],
                    ["partition", "segment", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )

    # One small row for each document: keep them, the totals and the result both read them.
    rows = written(arrow(spark.read.format("binaryFile").load(folder).select("content"), work, schema), "token-rows")
    files = rows.groupBy("partition", "segment").agg(F.sum("n_tokens").alias("n"))
    within = Window.partitionBy("partition").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("before_file", F.coalesce(F.sum("n").over(within), F.lit(0)))
    # One row for each partition that was written: the only step in one task.
    ahead = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("partition").agg(F.sum("n").alias("total"))
    parts = parts.select("partition", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("before_part"))
    starts = files.join(parts, "partition").select(
        "partition", "segment", (F.col("before_file") + F.col("before_part")).alias("before")
    )
    return rows.join(starts, ["partition", "segment"]).select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
