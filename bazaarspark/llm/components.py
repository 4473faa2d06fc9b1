"""Connected components of a graph given as edges, in rounds of joins.

Each task first reduces its own edges to stars (a spanning forest of what it holds), so a dense group costs no more
than its nodes. A round then points every node to its smallest neighbour, follows the pointers once more, and contracts
the edges; every node that has an edge merges, so few rounds remain. Nothing is collected but the number of edges left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, removed, written

TASK_EDGES = 1 << 20  # edges reduced together


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node number reachable from each of n nodes over the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        live = x != y
        if not live.any():
            break
        a, b, x, y = a[live], b[live], x[live], y[live]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def stars(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of 64-bit integers as stars around each task's smallest nodes: b > a, the same components."""

    def work(batches):
        held, n = [], 0

        def reduced():
            pairs = np.concatenate(held)
            nodes, at = np.unique(pairs, return_inverse=True)
            at = at.reshape(-1, 2)
            label = roots(len(nodes), at[:, 0], at[:, 1])
            moved = np.flatnonzero(label != np.arange(len(nodes)))
            return np.stack([nodes[label[moved]], nodes[moved]], axis=1)

        for batch in batches:
            held.append(np.stack([batch.column("a").to_numpy(), batch.column("b").to_numpy()], axis=1))
            n += batch.num_rows
            if n >= TASK_EDGES:
                found = reduced()
                if len(found) > n // 2:
                    yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])
                    held, n = [], 0
                else:
                    held, n = [found], len(found)
        if held:
            found = reduced()
            yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return arrow(edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")), work, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; component is the smallest node reachable."""
    left = written(stars(edges), "edges")
    found = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        up = up.select("node", F.least("node", "to").alias("to"))
        # Follow the pointer of the pointer.
        next_up = up.select(F.col("node").alias("to"), F.col("to").alias("further"))
        up = written(up.join(next_up, "to", "left").select("node", F.coalesce("further", "to").alias("to")), "up")
        a = up.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        b = up.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        moved = left.join(a, "a").join(b, "b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
        rest = written(stars(moved.filter("a <> b")), "edges")
        if found is None:
            new = up
        else:
            step = up.select(F.col("node").alias("to"), F.col("to").alias("further"))
            known = found.join(step, "to", "left").select("node", F.coalesce("further", "to").alias("to"))
            fresh = up.join(found, "node", "left_anti").select("node", "to")
            new = written(known.union(fresh), "found")
            removed(found)
            removed(up)
        removed(left)
        found, left = new, rest
    if found is None:
        found = left.select(F.col("a").alias("node"), F.col("b").alias("to"))
    return found.select("node", F.col("to").alias("component"))
