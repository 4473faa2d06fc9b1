"""Byte strings that occur twice, found with run-length indexes (run-compressed Burrows-Wheeler transforms).

A byte goes if a string of `LENGTH` bytes that covers it starts at any other place as well, in the same document or in
another one. All copies go; strings are judged on the input and never cross documents.

One index of a whole corpus would be one task, so windows of `LENGTH` bytes that can be equal are brought together first.
The anchor of a window is the first of its `ANCHOR`-byte strings with the smallest hash: equal windows have equal anchors
at equal distances. The windows around one place of an anchor are a segment, about one for every 170 bytes; no two of them
are equal. Anchors are counted over all documents. Where an anchor has one segment only, nothing in it repeats; where all
its segments are equal, all of them do; only anchors with different segments need an index, and each different segment
goes there once, however often it occurs.

The segments of an anchor meet in one shard of about `SHARD` bytes. Its text is indexed (`RunIndex`): the suffixes are
sorted, the transform is cut into runs, and the places of the first and last suffix of each run are the samples. Inside
a run the longest common prefix with the neighbouring suffix falls by one from place to place, so it is compared at the
samples only, and the matching statistics of the whole text are streamed from the samples. Places whose longest match
elsewhere reaches `LENGTH` start a repeated window.

An anchor with more than `CROWD` different segments (a passage in that many different surroundings) would outgrow a shard:
the windows of its segments are digested one by one and counted over all tasks instead.

Defined results: null and empty texts, and texts shorter than `LENGTH`, keep all bytes; repeated rows and equal texts of
different documents are occurrences of their own, so a text of `LENGTH` bytes or more that stands in two rows goes
entirely; null ids stay; very long texts are cut into overlapping parts of windows; other columns are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, removed, some_bytes, written

LENGTH = 400
ANCHOR = 64  # a power of two, below LENGTH
SHARD = 1 << 20  # bytes of segments in one index, and of text in one step
CROWD = 1 << 10  # different segments of an anchor for which an index is built
# Random 64-bit numbers from a rule: one for each byte, and two odd factors.
RANDOM = np.random.default_rng(400).integers(0, 1 << 64, 256, np.uint64)
FACTOR, MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
PLACE = np.uint64((1 << 24) - 1)  # bits of a place in a step's text


def anchors(raw: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the anchor of each window of `length` bytes starts, and its hash; len(raw) >= length, below 2^24.

    The hashes are compared by their higher 40 bits and, where these are equal, by place.
    """
    hashes, factor, size = RANDOM[raw], FACTOR, 1
    while size < anchor:  # strings of twice the size, from two neighbours
        hashes = hashes[:-size] * np.uint64(factor) + hashes[size:]
        factor, size = factor * factor % (1 << 64), 2 * size
    hashes ^= hashes >> np.uint64(32)
    hashes *= MIX
    hashes ^= hashes >> np.uint64(29)
    n, wide = len(hashes), length - anchor + 1
    keys = np.full((-(-n // wide), wide), ~np.uint64(0))
    keys.reshape(-1)[:n] = hashes & ~PLACE | np.arange(n, dtype=np.uint64)
    ahead = np.minimum.accumulate(keys, axis=1).reshape(-1)
    behind = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    places = (np.minimum(behind[: n - wide + 1], ahead[wide - 1 : n]) & PLACE).astype(np.int64)
    return places, hashes


def segments(raw: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """(text number, start in raw, windows, anchor) of the segments of texts that stand in `raw` between the offsets."""
    found, hashes = anchors(raw, length, anchor)
    starts, ends = offsets[:-1], offsets[1:] - length + 1  # of the windows of each text
    long = np.flatnonzero(ends > starts)
    steps = np.zeros(len(found) + 1, np.int32)
    np.add.at(steps, starts[long], 1)
    np.add.at(steps, ends[long], -1)
    valid = np.cumsum(steps) > 0  # one place more than windows
    first = np.zeros(len(found) + 1, bool)
    first[1:-1] = found[1:] != found[:-1]
    first[starts[long]] = True
    first[-1] = True
    at = np.flatnonzero(valid & first)
    windows = np.flatnonzero(valid[:-1] & (first[1:] | ~valid[1:])) - at + 1
    return np.searchsorted(offsets, at, "right") - 1, at, windows, hashes[found[at]]


def digested(raw: memoryview, at: list[int], ends: list[int]) -> np.ndarray:
    """128-bit digests of the strings, as two signed numbers each."""
    whole = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(at, ends)])
    return np.frombuffer(whole, ">i8").astype(np.int64).reshape(-1, 2)


def bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts (no nulls) in a row, and where each text starts and ends."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def segments_of(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(tid, start, windows, anchor, hi, lo) of the segments of texts (tid, text)."""

    def work(batches):
        for batch in some_bytes(batches, most=SHARD):
            raw, offsets = bytes_of(batch.column("text"))
            tids = batch.column("tid")
            if len(raw) <= 2 * SHARD:
                if len(raw) >= length:
                    yield made(tids, 0, raw, offsets)
                continue
            # A very long text (it is alone in its slice, or the last one): in parts that share length - 1 bytes.
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                for s in range(0, int(b - a) - length + 1, SHARD):
                    part = raw[a + s : min(a + s + SHARD + length - 1, b)]
                    yield made(tids.slice(i, 1), s, part, np.array([0, len(part)]))

    def made(tids, shift, raw, offsets):
        text, at, windows, found = segments(raw, offsets, length, anchor)
        digests = digested(memoryview(np.ascontiguousarray(raw)), at.tolist(), (at + windows + length - 1).tolist())
        columns = [tids.take(pa.array(text)), pa.array(at - offsets[text] + shift), pa.array(windows)]
        columns += [pa.array(found.view(np.int64)), pa.array(digests[:, 0]), pa.array(digests[:, 1])]
        return pa.record_batch(columns, ["tid", "start", "windows", "anchor", "hi", "lo"])

    return arrow(texts, work, "tid binary, start bigint, windows bigint, anchor bigint, hi bigint, lo bigint")


def suffix_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and ranks by the first `depth` symbols (a power of two, at least 4). No suffix is a prefix of another.

    Prefixes of twice the length are compared in each round, among the suffixes that are still tied.
    """
    n = len(symbols)
    padded = np.zeros(n + 4, np.uint64)
    padded[:n] = symbols
    keys = padded[:n] << 48 | padded[1 : n + 1] << 32 | padded[2 : n + 2] << 16 | padded[3 : n + 3]
    order = np.argsort(keys)
    keys = keys[order]
    slots, tied = np.arange(n), order
    rank, at_depth, size = np.zeros(n, np.int64), None, 4
    while True:
        new = np.r_[True, keys[1:] != keys[:-1]]
        rank[tied] = slots[new][np.cumsum(new) - 1]
        if size == depth:
            at_depth = rank.copy()
        left = ~(new & np.r_[new[1:], True])
        slots, tied = slots[left], tied[left]
        if not len(tied):
            return order, rank if at_depth is None else at_depth
        after = np.minimum(tied + size, n - 1)
        keys = rank[tied] << 32 | rank[after]
        by_key = np.argsort(keys)
        keys, tied = keys[by_key], tied[by_key]
        order[slots] = tied
        size *= 2


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of some strings, with the places of the first and last suffix of each run."""

    def __init__(self, strings: list[bytes], length: int):
        self.length, self.sizes = length, np.array([len(s) + 1 for s in strings])
        # An end mark of its own after each string: no match crosses it.
        raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        self.marks = np.cumsum(self.sizes) - 1
        self.symbols = raw.astype(np.uint16) + np.uint16(len(strings))
        self.symbols[self.marks] = np.arange(len(strings))
        depth = 4
        while 2 * depth <= length:
            depth *= 2
        order, self.ranks = suffix_order(self.symbols, depth)
        self.depth = depth
        transform = self.symbols[order - 1]
        change = np.flatnonzero(transform[1:] != transform[:-1]) + 1
        self.run_symbols = transform[np.r_[0, change]]
        self.run_lengths = np.diff(np.r_[0, change, len(order)])
        # Samples: the first suffix of each run but the first one, and the last suffix of the run before it.
        self.heads, self.tails = order[change], order[change - 1]

    def common(self) -> np.ndarray:
        """Bytes that the heads have in common with the tails before them; 0 where they are fewer than `length`."""
        rest, last = self.length - self.depth, len(self.symbols) - 1
        a, b = self.heads, self.tails
        equal = self.ranks[a] == self.ranks[b]
        equal &= self.ranks[np.minimum(a + rest, last)] == self.ranks[np.minimum(b + rest, last)]
        found = np.zeros(len(a), np.int64)
        at = np.flatnonzero(equal)
        found[at] = self.length
        while len(at):  # end marks differ, so this ends inside the strings
            same = self.symbols[a[at] + found[at]] == self.symbols[b[at] + found[at]]
            at = at[same]
            found[at] += 1
        return found

    def matching_statistics(self) -> np.ndarray:
        """For each place the length of its longest match elsewhere, where it reaches `length` (below: less than `length`).

        From a sample on, a place's match with its neighbour in suffix order is one shorter than that of the place before.
        """
        common, n = self.common(), len(self.symbols)
        longest = np.zeros(n, np.int64)
        for samples in (self.heads, self.tails):
            order = np.argsort(samples)
            starts = samples[order]
            reach = starts + common[order]  # where the match of the sample ends
            each = np.searchsorted(starts, np.arange(n), "right") - 1
            known = np.where(each >= 0, reach[np.maximum(each, 0)] - np.arange(n), 0)
            np.maximum(longest, known, out=longest)
        return longest

    def repeated(self) -> list[list[tuple[int, int]]]:
        """(start, end) of the bytes of each string that repeated windows cover."""
        starts = np.flatnonzero(self.matching_statistics() >= self.length)
        steps = np.zeros(len(self.symbols) + 1, np.int32)
        steps[starts] += 1
        np.add.at(steps, starts + self.length, -1)
        covered = np.cumsum(steps) > 0
        edges = np.flatnonzero(np.diff(np.r_[False, covered].astype(np.int8)))
        spans: list[list[tuple[int, int]]] = [[] for _ in self.sizes]
        firsts = np.r_[0, self.marks[:-1] + 1]
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            i = int(np.searchsorted(self.marks, s))
            spans[i].append((s - int(firsts[i]), e - int(firsts[i])))
        return spans


SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
SPANS_SQL = "array<struct<s:bigint,e:bigint>>"


def indexed(pieces: DataFrame, length: int) -> DataFrame:
    """(hi, lo, spans) of the pieces (anchor, hi, lo, piece) that hold repeated windows; the pieces of an anchor stand together."""

    def work(batches):
        held, size = [], 0
        for batch in some_bytes(batches, "piece", SHARD):
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "hi", "lo", "piece"))):
                if size >= SHARD and row[0] != held[-1][0]:
                    yield found(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield found(held)

    def found(rows):
        spans = RunIndex([r[3] for r in rows], length).repeated()
        some = [(r[1], r[2], [{"s": s, "e": e} for s, e in x]) for r, x in zip(rows, spans) if x]
        kinds = (pa.int64(), pa.int64(), SPANS)
        columns = [pa.array([r[i] for r in some], k) for i, k in enumerate(kinds)]
        return pa.record_batch(columns, ["hi", "lo", "spans"])

    ordered = pieces.repartition("anchor").sortWithinPartitions("anchor", "hi", "lo")
    return arrow(ordered.select("anchor", "hi", "lo", "piece"), work, f"hi bigint, lo bigint, spans {SPANS_SQL}")


def counted(pieces: DataFrame, length: int) -> DataFrame:
    """As `indexed`, for anchors of any number of pieces: windows are digested and counted over all tasks."""

    def work(batches):
        for batch in some_bytes(batches, "piece", SHARD // 32):
            raw, offsets = bytes_of(batch.column("piece"))
            counts = np.diff(offsets) - length + 1
            piece = np.repeat(np.arange(len(counts)), counts)
            place = np.arange(len(piece)) - (np.cumsum(counts) - counts)[piece]
            at = offsets[piece] + place
            digests = digested(memoryview(np.ascontiguousarray(raw)), at.tolist(), (at + length).tolist())
            hi, lo = (batch.column(c).take(pa.array(piece)) for c in ("hi", "lo"))
            columns = [hi, lo, pa.array(place), pa.array(digests[:, 0]), pa.array(digests[:, 1])]
            yield pa.record_batch(columns, ["hi", "lo", "place", "w_hi", "w_lo"])

    schema = "hi bigint, lo bigint, place bigint, w_hi bigint, w_lo bigint"
    windows = written(arrow(pieces.select("hi", "lo", "piece"), work, schema), "windows")
    twice = written(windows.groupBy("w_hi", "w_lo").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "windows-twice")
    found = windows.join(twice, ["w_hi", "w_lo"])
    span = F.struct(F.col("place").alias("s"), (F.col("place") + length).alias("e"))
    return found.groupBy("hi", "lo").agg(F.collect_list(span).alias("spans"))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, tid, text): a text's SHA-256 names it."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("tid"), text.alias("text")
    )


def distinct_texts(rows: DataFrame, length: int) -> DataFrame:
    """(tid, text) of the different texts that hold a window; copies go before the shuffle."""
    return rows.filter(F.octet_length("text") >= length).groupBy("tid").agg(F.any_value("text").alias("text"))


def with_pieces(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, hi, lo, crowded, piece) of the wanted segments, cut from their texts."""
    spots = F.struct("start", "windows", "anchor", "hi", "lo", "crowded")
    by_text = wanted.groupBy("tid").agg(F.collect_list(spots).alias("spots"))

    def work(batches):
        for batch in some_bytes(batches, most=SHARD):
            raw, offsets = bytes_of(batch.column("text"))
            whole = memoryview(np.ascontiguousarray(raw))
            rows = [
                (x["anchor"], x["hi"], x["lo"], x["crowded"], bytes(whole[o + x["start"] : o + x["start"] + x["windows"] + length - 1]))
                for o, spots in zip(offsets[:-1].tolist(), batch.column("spots").to_pylist())
                for x in spots
            ]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.record_batch(columns, ["anchor", "hi", "lo", "crowded", "piece"])

    schema = "anchor bigint, hi bigint, lo bigint, crowded boolean, piece binary"
    return arrow(texts.join(by_text, "tid").select("text", "spots"), work, schema)


def repeated_spans(rows: DataFrame, length: int, anchor: int = ANCHOR, crowd: int = CROWD) -> DataFrame:
    """(tid, spans) of the texts with repeated windows: byte ranges that repeated windows cover, unordered, overlapping."""
    texts = rows.filter(F.octet_length("text") >= length).select("tid", "text")
    found = written(segments_of(texts, length, anchor), "segments")
    ranges = [how(c).alias(f"{name}_{c}") for c in ("hi", "lo") for name, how in (("least", F.min), ("most", F.max))]
    several = found.groupBy("anchor").agg(F.count("*").alias("n"), *ranges).filter("n > 1")
    # A table of its own, so that the join can split what a frequent anchor brings to one partition.
    mixed = F.expr("least_hi < most_hi OR least_lo < most_lo").alias("mixed")
    several = written(several.select("anchor", mixed), "repeated-anchors")
    again = written(found.join(several, "anchor"), "repeated-segments")
    removed(found)
    removed(several)
    end = F.col("start") + F.col("windows") + length - 1
    spans = again.filter("NOT mixed").select("tid", F.col("start").alias("s"), end.alias("e"))
    # Different segments with one anchor, each once.
    mixed = again.filter("mixed")
    one = F.min(F.struct("tid", "start", "windows", "anchor")).alias("one")
    contents = mixed.groupBy("hi", "lo").agg(F.count("*").alias("n"), one).select("hi", "lo", "n", "one.*")
    contents = written(contents, "segment-contents")
    # Few anchors, in a table of their own: the join can split what one of them brings.
    crowds = contents.groupBy("anchor").agg(F.count("*").alias("several")).filter(F.col("several") > crowd)
    crowds = written(crowds.select("anchor", F.lit(True).alias("crowded")), "crowded-anchors")
    wanted = contents.join(crowds, "anchor", "left").fillna(False, ["crowded"])
    pieces = written(with_pieces(distinct_texts(rows, length), wanted, length), "pieces")
    removed(crowds)
    inside = indexed(pieces.filter("NOT crowded"), length)
    if not pieces.filter("crowded").isEmpty():
        inside = inside.unionByName(counted(pieces.filter("crowded"), length))
    inside = contents.filter("n = 1").select("hi", "lo").join(inside, ["hi", "lo"])
    every = F.array(F.struct(F.lit(0).cast("bigint").alias("s"), (F.col("windows") + length - 1).alias("e")))
    inside = written(contents.filter("n > 1").select("hi", "lo", every.alias("spans")).unionByName(inside), "content-spans")
    removed(pieces)
    removed(contents)
    more = mixed.join(inside, ["hi", "lo"]).select("tid", "start", F.explode("spans").alias("x"))
    more = more.select("tid", (F.col("start") + F.col("x.s")).alias("s"), (F.col("start") + F.col("x.e")).alias("e"))
    spans = spans.unionByName(more).groupBy("tid").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    return written(spans, "repeated-spans")


def cut_texts(rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, crowd: int = CROWD) -> DataFrame:
    """(tid, spans, kept) of the different texts with repeated windows: merged byte ranges, and the bytes that stay."""
    spans = repeated_spans(rows, length, anchor, crowd)

    def work(batches):
        for batch in some_bytes(batches, most=SHARD):
            raw, offsets = bytes_of(batch.column("text"))
            whole = memoryview(np.ascontiguousarray(raw))
            merged, kept = [], []
            for a, b, spans in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column("spans").to_pylist()):
                runs: list[list[int]] = []
                for s, e in sorted((x["s"], x["e"]) for x in spans):
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(e, runs[-1][1])
                    else:
                        runs.append([s, e])
                edges = [a, *(a + x for run in runs for x in run), b]
                kept.append(b"".join(whole[s:e] for s, e in zip(edges[::2], edges[1::2])))
                merged.append([{"s": s, "e": e} for s, e in runs])
            columns = [batch.column("tid"), pa.array(merged, SPANS), pa.array(kept, pa.binary())]
            yield pa.record_batch(columns, ["tid", "spans", "kept"])

    texts = distinct_texts(rows, length).join(spans, "tid")
    return arrow(texts.select("tid", "text", "spans"), work, f"tid binary, spans {SPANS_SQL}, kept binary")


def without_long_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, removed (byte ranges of the text), kept (bytes) of every document. Cuts may part a character's bytes."""
    rows = keyed(docs)
    found = rows.join(cut_texts(rows, length), "tid", "left")
    none = F.array().cast(SPANS_SQL)
    kept = F.coalesce("kept", F.col("text").cast("binary")).alias("kept")
    return found.select("doc_id", F.coalesce("spans", none).alias("removed"), kept)


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = keyed(docs)
    size = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["e"] - x["s"])
    cut = cut_texts(rows, length).select(
        "tid", size.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
    # A text that stays whole is named by the digest of its bytes.
    small = rows.select("doc_id", "tid", F.octet_length("text").cast("bigint").alias("n_bytes"))
    zero = F.lit(0).cast("bigint")
    return small.join(cut, "tid", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("tid"))).alias("kept_sha256"),
    )


SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS code, strlen(coalesce(text, '')) AS n_bytes
    FROM documents
), windows AS (
    SELECT row, start, md5(substr(code, 2 * start + 1, {2 * LENGTH})) AS digest
    FROM texts, range(0, n_bytes - {LENGTH} + 1) r(start)
), twice AS (
    SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1
), starts AS (
    SELECT row, start, start - coalesce(lag(start) OVER (PARTITION BY row ORDER BY start), -{LENGTH} - 1) > {LENGTH} AS new
    FROM windows WHERE digest IN (SELECT digest FROM twice)
), numbered AS (
    SELECT row, start, count(*) FILTER (new) OVER (PARTITION BY row ORDER BY start) AS span FROM starts
), spans AS (
    SELECT row, span, min(start) AS s, max(start) + {LENGTH} AS e FROM numbered GROUP BY row, span
), gaps AS (
    SELECT row, e AS s, lead(s) OVER (PARTITION BY row ORDER BY s) AS e FROM spans
    UNION ALL SELECT row, 0, min(s) FROM spans GROUP BY row
), kept AS (
    SELECT row, string_agg(substr(code, 2 * s + 1, 2 * (coalesce(e, n_bytes) - s)), '' ORDER BY s) AS code
    FROM gaps JOIN texts USING (row) GROUP BY row
), sums AS (
    SELECT row, sum(e - s) AS n_removed, count(*) AS n_spans FROM spans GROUP BY row
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.code, texts.code))) AS kept_sha256
FROM texts LEFT JOIN sums USING (row) LEFT JOIN kept USING (row)
"""
