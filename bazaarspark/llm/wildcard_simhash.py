"""SimHash near-duplicates by one-wildcard segment variants.

A fingerprint is cut into segments, as few as leave one of them with at most one of the differing bits: distance // 2 + 1
(3 for up to 5 bits, 4 for up to 7). Two segments differ by one bit at most exactly if they agree on all but one bit, so
each segment gives one key for each of its bits left out. Equal keys are candidates; their whole fingerprints are
compared.

Equal fingerprints are one node. Rows of a key meet in one task; a key with more than `TILE` fingerprints is dealt over
pairs of blocks, so no task holds more than two blocks, and a task returns a spanning forest of its links, never all
pairs. Two fingerprints that link share a key, and a shared key compares all its pairs: no link between fingerprints is
lost.

Defined results: a null or empty text, or one without words, has fingerprint zero and links like any other; fewer words
than a shingle make one shingle; rows with the same text link; rows with a null id take part in linking, and a component
without any id has a null component_id; other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, quoted, some_bytes, written
from bazaarspark.llm.components import components, roots

BITS, DISTANCE = 64, 4
SHINGLE, SEED = 4, 42
TILE = 2048  # fingerprints of a key that are compared in one block
PART = 200_000  # shingles of a text that are counted together


def cuts(distance: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of the segments: as few as leave one with one differing bit at most."""
    n = distance // 2 + 1
    ends = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """64 bits: each set if it is set in over half of the digests of the word shingles, repeats included."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) < size:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(BITS, np.int64), 0
    while True:
        part = np.array([digest(s, SEED) for s in islice(shingles, PART)], "<u8")
        if not len(part):
            break
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, tie, fp) of every document: tie is a digest of the text, fp the fingerprint as a signed integer."""

    def work(batches):
        for batch in some_bytes(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t or b"", size) for t in texts], np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), batch.column("tie"), pa.array(found)]
            yield pa.record_batch(columns, ["doc_id", "tie", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    return arrow(rows, work, "doc_id bigint, tie bigint, fp bigint")


def variants(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(key, fp): one row for each bit left out of each segment. The key names the segment, the bit and the rest."""
    keys, number = [], 0
    for first, width in cuts(distance):
        segment = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            rest = segment.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << bit)))
            keys.append(rest.bitwiseOR(F.lit(number << 32)))
            number += 1
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def dealt(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """(key, tile_a, tile_b, side, fp): each key's rows, dealt over pairs of blocks where they are many."""
    hot = rows.groupBy("key").count().filter(F.col("count") > tile)
    hot = hot.select("key", F.ceil(F.col("count") / (tile / 2)).cast("int").alias("blocks"))
    rows = rows.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("bigint")).cast("int")
    rows = rows.withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("key", "fp", "block", other.alias("other"))
    return rows.select("key", F.least("block", "other").alias("tile_a"), F.greatest("block", "other").alias("tile_b"), "fp")


def links(group: np.ndarray, fp: np.ndarray, distance: int) -> pa.RecordBatch:
    """Edges (a, b) that span the links within each group; groups stand together."""
    n = len(fp)
    label = np.arange(n)
    at, step = np.arange(n - 1), 1
    while len(at):
        at = at[at + step < n]
        at = at[group[at] == group[at + step]]
        near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= distance]
        if len(near) and (label[near] != label[near + step]).any():
            # In this order: labels stay roots, so the next offset's links join whole trees.
            label = roots(n, label[near], label[near + step])[label]
        step += 1
    moved = np.flatnonzero(label != np.arange(n))
    return pa.record_batch(
        [pa.array(fp[label[moved]].view(np.int64)), pa.array(fp[moved].view(np.int64))], ["a", "b"]
    )


def linked(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) that span the links among the rows of each tile; rows of a tile stand together, in order."""

    def work(batches):
        held = None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("key", "tile_a", "tile_b")]
            rows = np.stack([k.astype(np.int64) for k in keys] + [batch.column("fp").to_numpy()], axis=1)
            held = rows if held is None else np.concatenate([held, rows])
            change = np.flatnonzero((held[1:, :3] != held[:-1, :3]).any(axis=1))
            if len(change):  # the last tile may go on in the next batch
                done, held = held[: change[-1] + 1], held[change[-1] + 1 :]
                yield found(done)
        if held is not None and len(held):
            yield found(held)

    def found(rows: np.ndarray):
        new = np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)]
        return links(np.cumsum(new), rows[:, 3].astype(np.int64).view(np.uint64), distance)

    ordered = rows.repartition("key", "tile_a", "tile_b").sortWithinPartitions("key", "tile_a", "tile_b", "fp")
    return arrow(ordered, work, "a bigint, b bigint")


def simhash_classes(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, tie, fp, component, component_id) of every document: component_id is the smallest doc_id its links reach."""
    rows = written(fingerprints(docs, size), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    found = components(linked(dealt(variants(nodes.select("fp"), distance)), distance))
    named = nodes.join(found, nodes.fp == found.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    named = written(named, "fingerprint-components")
    first = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = named.join(first, "component").select("fp", "component", "component_id")
    return rows.join(classes, "fp").select("doc_id", "tie", "fp", "component", "component_id")


def simhash_digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id."""
    found = simhash_classes(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents, all columns unchanged, with one of each group: the smallest doc_id (nulls last), then text digest."""
    last = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    kept = simhash_classes(docs, size, distance).groupBy("component").agg(F.min(last).alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias("_id"), F.col("kept.tie").alias("_tie"))
    rows = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("tie"),
    )
    found = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")))
    # Repeated rows are one document; where other columns differ, the first of them by their values is it.
    others = F.to_json(F.struct(*(F.col(f"_row.{quoted(c)}").alias(c) for c in docs.columns if c != "text")))
    found = found.groupBy("_id", "_tie").agg(F.min_by("_row", others).alias("_row"))
    return found.select(*(F.col(f"_row.{quoted(c)}").alias(c) for c in docs.columns))
