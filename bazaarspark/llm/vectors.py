"""Vectors as rows of a table: which of them take part, how they are ordered into blocks, and how blocks meet."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, removed, written

PIVOTS = 64  # rows that order the others: a bounded sample, which decides the order only


def usable(column: str = "embedding") -> Column:
    """True for a vector that is not null, not empty, and has finite components only."""
    v = F.col(column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine, F.lit(False))


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """The vectors of an Arrow column as doubles, filled up with zeros to `dim` components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim) < sizes[:, None]] = values
    return out


def lengths(column: pa.ListArray) -> np.ndarray:
    return np.diff(column.offsets.to_numpy())


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a row of zeros stays."""
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def near_together(rows: DataFrame, column: str, tie: str) -> DataFrame:
    """The rows sorted and range-partitioned so that similar vectors stand together: by the nearest of a few pivots.

    Pivots are the first rows by a digest of `tie`; another choice changes the order and no result.
    """
    first = rows.select(column, tie).orderBy(F.xxhash64(tie), tie).limit(PIVOTS).collect()
    pivots = [np.array(r[0], np.float64) for r in first]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def work(batches):
        for batch in batches:
            v = batch.column(column)
            dims = lengths(v)
            dim = int(max([*dims, *map(len, pivots)], default=1))
            x = unit(matrix(v, dim))
            p = unit(np.stack([np.pad(q, (0, dim - len(q))) for q in pivots]))
            near = x @ p.T
            best = near.argmax(axis=1)
            columns = [*batch.columns, pa.array(best.astype(np.int32)), pa.array(-near.max(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "pivot", "closeness"])

    marked = arrow(rows, work, f"{fields}, pivot int, closeness double")
    order = ("pivot", "closeness", tie)
    return marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("pivot", "closeness")


def in_lists(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """The rows in lists of `size` in their present order, one row for each list, numbered from 0 in `tile`; their number.

    Every column becomes an array. Rows are counted through all partitions, so small partitions make no small lists.
    """
    names = rows.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def place(batches):
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            places = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(k, k + n))]
            yield pa.RecordBatch.from_arrays([*places, *batch.columns], ["_part", "_k", *names])
            k += n

    placed = written(arrow(rows, place, f"_part int, _k bigint, {fields}"), f"{name}-rows")
    # How many rows each partition has: as short as the list of partitions.
    counts = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for part, n in counts:
        starts += [F.lit(part), F.lit(total)]
        total += n
    first = F.create_map(*starts)[F.col("_part")] if starts else F.lit(0)
    numbered = placed.select(((first + F.col("_k")) / size).cast("int").alias("tile"), (first + F.col("_k")).alias("_at"), *names)

    def cut(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            tile = batch.column("tile").to_numpy()
            edges = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                if held and held[0].column("tile")[0].as_py() != tile[start]:
                    yield one(held)
                    held = []
                held.append(batch.slice(start, end - start))
        if held:
            yield one(held)

    def one(held: list):
        t = pa.Table.from_batches(held)
        columns = [t.column(c).combine_chunks() for c in names]
        listed = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
        return pa.record_batch([pa.array([t.column("tile")[0].as_py()], pa.int32()), *listed], ["tile", *names])

    lists = ", ".join(f"`{f.name}` array<{f.dataType.simpleString()}>" for f in rows.schema)
    n_lists = -(-total // size)
    ordered = numbered.repartition(max(1, n_lists), "tile").sortWithinPartitions("tile", "_at")
    found = written(arrow(ordered, cut, f"tile int, {lists}"), name)
    removed(placed)
    return found, n_lists
