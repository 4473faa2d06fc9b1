"""Embedding near-duplicates by int8 quantised tile products with rigorous error bounds.

Vectors are scaled to length one and quantised to whole numbers from -127 to 127 with a scale of their own; the length
of what quantising lost is kept with each vector. For unit vectors x, y with quantised forms x', y':
|x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'| <= e + f + e f. The products of whole numbers are exact (float32 carries
whole numbers below 2^24 exactly, the products stay below it for up to 1,040 components, and longer vectors are
multiplied in parts). Only pairs whose bound reaches the threshold are computed again in double precision.

Equal vectors are one row with a count. Rows are cut into tiles of `TILE` in an order that puts similar vectors
together; each pair of tiles meets in one task, which skips the pair if the tiles' centres and radii show that they are
too far apart. A task returns link counts of its rows and a spanning forest of its links, never the pairs themselves.

Every pair of tiles is visited, so work grows with the square of the number of different vectors; memory does not.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; so do
vectors of unequal length. Rows of the same vec_id with different vectors are different rows that share their id, and
each gives one row of the result; rows with a null vec_id count as links of others and have no component of their own
unless a named vector is reached. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, written
from bazaarspark.llm.components import components, roots
from bazaarspark.llm.vectors import in_lists, lengths, matrix, near_together, unit, usable

THRESHOLD = 0.9
TILE = 4096
PART = 512  # rows of a tile whose products are held at once
EXACT = 1024  # components whose quantised products add up below 2^24


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers of unit rows, their scales, and bounds of what quantising lost."""
    top = np.abs(x).max(axis=1)
    scale = np.where(top > 0, top, 1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    lost = x - q * scale[:, None]
    return q, scale, np.sqrt((lost * lost).sum(axis=1)) * (1 + 1e-9) + 1e-12


def whole_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows, exact."""
    if a.shape[1] <= EXACT:
        return a.astype(np.float32) @ b.astype(np.float32).T
    parts = range(0, a.shape[1], EXACT)
    return sum((whole_products(a[:, k : k + EXACT], b[:, k : k + EXACT]).astype(np.float64) for k in parts))


def tile_links(a: dict, b: dict, same: bool, threshold: float):
    """Pairs (row of a, row of b) with cosine of at least `threshold`, in parts."""
    if not same:
        angle = np.arccos(np.clip(a["centre"] @ b["centre"], -1, 1)) - a["radius"] - b["radius"]
        if angle > np.arccos(threshold) + 1e-6:
            return
    for i in range(0, len(a["x"]), PART):
        part = slice(i, i + PART)
        near = whole_products(a["q"][part], b["q"]) * (a["scale"][part, None] * b["scale"]).astype(np.float32)
        bound = a["lost"][part, None] + b["lost"] + a["lost"][part, None] * b["lost"]
        # The scaling above is in single precision: its own rounding is part of the bound.
        maybe = near + bound.astype(np.float32) >= np.float32(threshold - 1e-5)
        rows, cols = np.nonzero(maybe)
        if same:
            rows, cols = rows[cols > rows + i], cols[cols > rows + i]
        if not len(rows):
            continue
        if len(rows) > 0.05 * maybe.size:  # many: as products of the rows and columns concerned
            r, c = np.unique(rows), np.unique(cols)
            exact = a["x"][part][r] @ b["x"][c].T
            cosine = exact[np.searchsorted(r, rows), np.searchsorted(c, cols)]
        else:
            cosine = np.concatenate(
                [
                    np.einsum("ij,ij->i", a["x"][i + rows[k : k + 65536]], b["x"][cols[k : k + 65536]])
                    for k in range(0, len(rows), 65536)
                ]
            )
        fine = (cosine >= threshold) & (a["dims"][i + rows] == b["dims"][cols])
        yield i + rows[fine], cols[fine]


def described(ids: np.ndarray, copies: np.ndarray, v: pa.ListArray) -> dict:
    dims = lengths(v)
    x = unit(matrix(v, int(dims.max())))
    q, scale, lost = quantised(x)
    centre = unit(x.mean(axis=0, keepdims=True))[0]
    radius = np.arccos(np.clip((x @ centre).min(), -1, 1)) + 1e-9
    out = {"ids": ids, "copies": copies, "dims": dims, "x": x, "q": q, "scale": scale, "lost": lost}
    return out | {"centre": centre, "radius": radius}


def padded(tile: dict, dim: int) -> dict:
    more = dim - tile["x"].shape[1]
    if not more:
        return tile
    wide = {k: np.pad(tile[k], ((0, 0), (0, more))) for k in ("x", "q")}
    return tile | wide | {"centre": np.pad(tile["centre"], (0, more))}


def found(one: dict, two: dict, same: bool, threshold: float) -> pa.RecordBatch:
    """Link counts of the rows of two tiles (or of one) and a spanning forest of their links."""
    dim = max(one["x"].shape[1], two["x"].shape[1])
    one, two = padded(one, dim), padded(two, dim)
    n, m = len(one["ids"]), len(two["ids"])
    shift = 0 if same else n
    label, links = np.arange(n if same else n + m), np.zeros(n if same else n + m, np.int64)
    for i, j in tile_links(one, two, same, threshold):
        np.add.at(links, i, two["copies"][j])
        np.add.at(links, shift + j, one["copies"][i])
        if (label[i] != label[shift + j]).any():
            # In this order: labels stay roots, so the next part's links join whole trees.
            label = roots(len(label), label[i], label[shift + j])[label]
    ids = one["ids"] if same else np.concatenate([one["ids"], two["ids"]])
    counted, moved = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(label)))
    node = np.concatenate([ids[counted], ids[moved]])
    other = pa.array(
        np.concatenate([np.zeros(len(counted), np.int64), ids[label[moved]]]),
        mask=np.arange(len(node)) < len(counted),
    )
    n_links = np.concatenate([links[counted], np.zeros(len(moved), np.int64)])
    return pa.record_batch([pa.array(node), other, pa.array(n_links)], ["node", "other", "links"])


def met(cut: DataFrame, total: int, threshold: float) -> DataFrame:
    """(node, other, links): link counts of nodes (other is null) and edges between them, from all pairs of tiles."""
    other = F.explode(F.sequence(F.lit(0), F.lit(max(0, total - 1)))).alias("other")
    both = cut.select("tile", other, "node", "copies", "embedding").select(
        F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "*"
    )
    both = both.select("a", "b", "tile", "node", "copies", "embedding")
    placed = both.repartition(max(1, min(total * (total + 1) // 2, 20_000)), "a", "b").sortWithinPartitions("a", "b", "tile")

    def work(batches):
        first = None
        for batch in batches:
            for k in range(batch.num_rows):
                a, b, tile = (batch.column(c)[k].as_py() for c in ("a", "b", "tile"))
                lists = [batch.column(c)[k].values for c in ("node", "copies", "embedding")]
                this = described(lists[0].to_numpy(), lists[1].to_numpy(), lists[2])
                if a == b:
                    yield found(this, this, True, threshold)
                elif tile == a:
                    first = this
                else:
                    yield found(first, this, False, threshold)
                    first = None

    return arrow(placed, work, "node bigint, other bigint, links bigint")


def neighbour_classes(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    nonzero = F.exists("embedding", lambda x: x != 0)
    fit = rows.filter(usable() & nonzero)
    # One node for each different vector; the written table fixes the numbers.
    nodes = fit.groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    ordered = near_together(nodes.select("node", "copies", "embedding"), "embedding", "node")
    cut, total = in_lists(ordered, tile, "tiles")
    links = written(met(cut, total, threshold), "vector-links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    edges = links.filter(F.col("other").isNotNull()).select(F.col("node").alias("a"), F.col("other").alias("b"))
    found = components(edges).select(F.col("node"), "component")
    named = nodes.join(found, "node", "left").join(counts, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    named = written(named, "vector-components")
    first = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = named.join(first, "component").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    placed = fit.join(classes, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~(usable() & F.coalesce(nonzero, F.lit(False))))
    alone = alone.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


SQL = """
WITH RECURSIVE fit AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM fit a JOIN fit b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
    SELECT vec_id AS node, vec_id AS other FROM embeddings
    UNION
    SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
), grouped AS (
    SELECT node, min(other) AS component_id FROM reached GROUP BY node
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN grouped ON node = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = e.vec_id
"""
