"""Exact top-k by integer inner product with block-at-a-time pruning.

Components become floor(256 x). Rows are ordered so that similar vectors stand together and cut into document ranges
(shards) of blocks. A block keeps the largest and smallest value of each component (its term maxima; a negative query
component takes the smallest), and its rows as a forward index. The sum over components bounds every score of a block
from above: a query visits a shard's blocks in the order of their bounds and stops when the next bound falls below its
kth score. Shards meet batches of queries in tasks of their own; the best of all shards are merged at the end.

Queries are a stated set of rows (every `every`th vec_id) against all rows, in blocks.

Defined results: vectors that are null, empty, or hold null or non-finite components, and rows with a null vec_id, take
no part; vectors of unequal length do not meet; a candidate with the query's vec_id is the query's own; further copies
of a candidate row are candidates of their own, copies of a query row are one query; scores beyond 64 bits are cut to
the largest or smallest such number; other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow
from bazaarspark.llm.vectors import in_lists, lengths, matrix, near_together, usable

K, EVERY = 5, 50
SCALE = 256
BLOCK, SHARD = 64, 8192  # rows of a block, and of a shard
QUERIES = 1024  # queries of a batch
LARGEST = np.iinfo(np.int64).max


def whole(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """floor(256 x) of the vectors as whole doubles, and their lengths."""
    dims = lengths(column)
    return np.floor(SCALE * matrix(column, int(max(dims, default=1)))), dims


class Shard:
    def __init__(self, ids: np.ndarray, vectors: pa.ListArray):
        self.ids = ids
        self.rows, self.dims = whole(vectors)
        begin = np.arange(0, len(ids), BLOCK)
        self.most = np.maximum.reduceat(self.rows, begin)
        self.least = np.minimum.reduceat(self.rows, begin)

    def top(self, query_id: int, q: np.ndarray, dim: int, k: int) -> tuple[np.ndarray, list[int]]:
        """Ids and scores of the shard's k best rows for a query."""
        width = self.rows.shape[1]
        if dim > width:
            return np.zeros(0, np.int64), []
        q = np.pad(q[:dim], (0, width - dim))
        # Doubles carry whole numbers below 2^53 exactly; larger products are taken as Python's own whole numbers.
        exact = float(np.abs(q) @ np.maximum(np.abs(self.most), np.abs(self.least)).max(axis=0)) < 2.0**53
        if exact:
            bounds = np.maximum(q, 0) @ self.most.T + np.minimum(q, 0) @ self.least.T
            order = np.argsort(-bounds, kind="stable")
        else:
            bounds, order = np.full(len(self.most), np.inf), np.arange(len(self.most))
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 1
        while at < len(order):
            if len(scores) == k and bounds[order[at]] < scores[-1]:
                break
            some = order[at : at + step]
            at, step = at + step, min(2 * step, 64)
            rows = (some[:, None] * BLOCK + np.arange(BLOCK)).reshape(-1)
            rows = rows[rows < len(self.ids)]
            rows = rows[(self.dims[rows] == dim) & (self.ids[rows] != query_id)]
            if exact:
                new = self.rows[rows] @ q
            else:
                new = np.array([sum(int(a) * int(b) for a, b in zip(r, q)) for r in self.rows[rows]], object)
                scores = scores.astype(object)
            ids, scores = np.concatenate([ids, self.ids[rows]]), np.concatenate([scores, new])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        return ids, [max(-LARGEST - 1, min(LARGEST, int(s))) for s in scores]


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    rows = rows.filter(usable() & F.col("vec_id").isNotNull())
    shards, n_shards = in_lists(near_together(rows, "embedding", "vec_id"), SHARD, "search-shards")
    queries = rows.filter(F.col("vec_id") % every == 0).distinct().repartitionByRange("vec_id")
    asked, _ = in_lists(queries.sortWithinPartitions("vec_id"), QUERIES, "search-queries")
    # Each batch of queries goes to every shard, behind the shard's one row.
    asked = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(max(0, n_shards - 1)))).alias("tile"), F.lit(1).alias("kind"), "vec_id", "embedding"
    )
    both = shards.select("tile", F.lit(0).alias("kind"), "vec_id", "embedding").union(asked)
    ordered = both.repartition(max(1, n_shards), "tile").sortWithinPartitions("tile", "kind")

    def work(batches):
        shard = None
        for batch in batches:
            for i in range(batch.num_rows):
                ids, v = batch.column("vec_id")[i].values.to_numpy(), batch.column("embedding")[i].values
                if batch.column("kind")[i].as_py() == 0:
                    shard = Shard(ids, v)
                    continue
                q, dims = whole(v)
                found = [shard.top(int(ids[j]), q[j], int(dims[j]), k) for j in range(len(ids))]
                sizes = [len(f[1]) for f in found]
                marks = [xxhash.xxh64_intdigest(q[j, : dims[j]].tobytes()) for j in range(len(ids))]
                # A query is its id and its vector: two vectors may share an id.
                yield pa.record_batch(
                    [
                        pa.array(np.repeat(ids, sizes)),
                        pa.array(np.repeat(np.array(marks, np.uint64).view(np.int64), sizes)),
                        pa.array(np.concatenate([f[0] for f in found] or [[]]), pa.int64()),
                        pa.array([s for f in found for s in f[1]], pa.int64()),
                    ],
                    ["query_id", "query", "vec_id", "score"],
                )

    found = arrow(ordered, work, "query_id bigint, query bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH fit AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM fit q JOIN fit c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 5
"""
