"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target is a share of all words, at most `MOST` times its own. A document is repeated floor(r) times, r being
its source's target over its source's size, and once more with probability r - floor(r). These fractional inclusion
probabilities are moved at random through the null space of the balancing constraints (documents and words of the
source) until almost all are 0 or 1: the flight phase. It runs in blocks of each source, by a digest; the at most two
units that a block leaves undecided meet in blocks of the next level, until a source has one block. What is left then is
decided by dropping the document constraint first, then the word constraint: the landing phase.

Defined results: a document's size is its number of words, 0 for null or empty texts; a null source is a source, the last
one; rows with the same doc_id, source and text are one unit, decided alike; a source without words has target 0; order
and random numbers come from digests, so reruns agree; other columns are kept by `mixed` and not read by `mixing_plan`;
an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
UNITS = 20_000  # units of a block
WORDS = r"[^\x20\x09-\x0D]+"
EDGE = 1e-9


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> list[float]:
    """Targets of sources in their order: shares by weight, the excess over `most` times a size reshared."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out: list[float | None] = [None] * len(sizes)
    left = float(sum(sizes))
    while True:
        open_ = [i for i, t in enumerate(out) if t is None]
        total = sum(weight[i] for i in open_)
        over = [i for i in open_ if left * weight[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weight[i] / total
            return [float(t or 0) for t in out]
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]


def flight(p: list[float], size: list[float], count: list[float], draw) -> None:
    """Move p in place to 0 or 1, but for two units at most, keeping both sums of p * count and p * size."""
    active: list[int] = []
    k, n = 0, len(p)
    while True:
        while len(active) < 3 and k < n:
            if EDGE < p[k] < 1 - EDGE:
                active.append(k)
            else:
                p[k] = float(round(p[k]))
            k += 1
        if len(active) < 3:
            return
        a, b, c = active
        u = (
            count[b] * size[c] - count[c] * size[b],
            count[c] * size[a] - count[a] * size[c],
            count[a] * size[b] - count[b] * size[a],
        )
        if not any(u):
            u = (count[b], -count[a], 0.0)  # proportional rows: two units are enough
        move(p, active, u, draw())
        active = [i for i in active if EDGE < p[i] < 1 - EDGE]


def move(p: list[float], active: list[int], u, chance: float) -> None:
    """One step along u or against it, as far as the unit cube allows, so that p stays the expectation."""
    up = min([(1 - p[i]) / x if x > 0 else -p[i] / x for i, x in zip(active, u) if x])
    down = min([p[i] / x if x > 0 else (p[i] - 1) / x for i, x in zip(active, u) if x])
    step = up if chance * (up + down) < down else -down
    for i, x in zip(active, u):
        p[i] += step * x
        if p[i] < EDGE:
            p[i] = 0.0
        elif p[i] > 1 - EDGE:
            p[i] = 1.0


def landing(p: list[float], size: list[float], draw) -> None:
    """Decide what flight has left: first along the words alone, then each unit by itself."""
    left = [i for i in range(len(p)) if EDGE < p[i] < 1 - EDGE]
    while len(left) > 1:
        a, b = left[:2]
        u = (size[b], -size[a]) if size[a] or size[b] else (1.0, -1.0)
        move(p, [a, b], u, draw())
        left = [i for i in left if EDGE < p[i] < 1 - EDGE]
    for i in left:
        p[i] = 1.0 if draw() < p[i] else 0.0


def settled(units: DataFrame, last: bool) -> DataFrame:
    """Flight (and landing, at the last level) in each (source_no, block): the units with p moved."""
    names = ["source_no", "block", "unit", "size", "n", "p"]

    def done(t: pa.Table):
        source_no, block = (t.column(c)[0].as_py() for c in ("source_no", "block"))
        rng = np.random.default_rng([source_no, block, int(last)])
        size, n, p = (t.column(c).to_numpy().astype(float).tolist() for c in ("size", "n", "p"))
        size = [s * k for s, k in zip(size, n)]
        # Large units first, equal ones at random, so that what is left to landing is small; numbers are drawn together.
        order = np.lexsort((rng.permutation(len(p)), -np.array(size)))
        size, n, p = ([x[i] for i in order] for x in (size, n, p))
        draw = iter(rng.random(4 * len(p) + 16).tolist()).__next__
        flight(p, size, n, draw)
        if last:
            landing(p, size, draw)
        moved = np.empty(len(p))
        moved[order] = p
        return t.set_column(t.schema.get_field_index("p"), "p", pa.array(moved)).to_batches()

    def work(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            a, b = (held.column(c).to_numpy() for c in ("source_no", "block"))
            change = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            cuts = [0, *change.tolist()]
            for s, e in zip(cuts, cuts[1:]):
                yield from done(held.slice(s, e - s))
            held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from done(held)

    ordered = units.select(names).repartition("source_no", "block").sortWithinPartitions("source_no", "block", "unit")
    return arrow(ordered, work, "source_no int, block bigint, unit bigint, size bigint, n bigint, p double")


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, digest, size) of every document."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "source",
        F.xxhash64("text").alias("digest"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("bigint").alias("size"),
    )


def decided(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, source, digest, size, source_size, target, copies) of the different rows of `measured`.

    The list of sources is collected: names and totals, not documents.
    """
    units = rows.groupBy("doc_id", "source", "digest").agg(F.first("size").alias("size"), F.count("*").alias("n"))
    units = written(units.withColumn("unit", F.monotonically_increasing_id()), "mix-units")
    key = F.xxhash64("doc_id", "source", "digest", F.lit(1))
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.count("*").alias("units"))
    found = sorted(totals.collect(), key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    goal = targets([r["size"] for r in found], weights) if found else []
    plan = [
        (i, r["source"], r["size"], t, max(1, math.ceil(r["units"] / UNITS))) for i, (r, t) in enumerate(zip(found, goal))
    ]
    spark = rows.sparkSession
    schema = "source_no int, source string, source_size bigint, target double, blocks int"
    plan_rows = spark.createDataFrame(plan, schema)
    units = units.join(plan_rows, units.source.eqNullSafe(plan_rows.source)).drop(plan_rows.source)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = units.withColumn("rate", F.least(rate, F.lit(float(MOST)))).withColumn("base", F.floor("rate"))
    units = units.withColumn("p", F.col("rate") - F.col("base"))
    # Order and blocks follow digests of the rows, not the numbers of this run.
    keyed = units.withColumn("key", key)
    level = keyed.select(
        "source_no", F.pmod("key", F.col("blocks").cast("bigint")).alias("block"), F.col("key").alias("unit"), "size", "n", "p"
    )
    blocks = max((b for *_, b in plan), default=1)
    states = []
    while True:
        level = written(settled(level, last=blocks == 1), "mix-level")
        states.append(level.filter((F.col("p") <= 0) | (F.col("p") >= 1)))
        if blocks == 1:
            break
        # Two units of a block at most are open: ever fewer blocks.
        blocks = math.ceil(2 * blocks / UNITS)
        level = level.filter((F.col("p") > 0) & (F.col("p") < 1)).withColumn("block", F.pmod("unit", F.lit(blocks)))
    ended = states[0]
    for more in states[1:]:
        ended = ended.union(more)
    ended = ended.select(F.col("source_no").alias("no"), F.col("unit").alias("key"), F.round("p").cast("int").alias("more"))
    # Units whose digests agree are one to the join: the smallest decision holds for them.
    ended = ended.groupBy("no", "key").agg(F.min("more").alias("more"))
    joined = keyed.join(ended, (keyed.key == ended.key) & (keyed.source_no == ended.no))
    copies = F.least(F.col("base") + F.col("more"), F.lit(MOST)).cast("int")
    return joined.select("doc_id", "source", "digest", "size", "source_size", "target", copies.alias("copies"))


def joined_rows(rows: DataFrame, plan: DataFrame) -> DataFrame:
    plan = plan.select(*(F.col(c).alias(f"_mix_{c}") for c in ("doc_id", "source", "digest", "copies", "source_size", "target")))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_mix_doc_id"))
        & F.col("source").eqNullSafe(F.col("_mix_source"))
        & (F.col("digest") == F.col("_mix_digest"))
    )
    return rows.join(plan, same)


def mixing_plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """doc_id, size, source_size, target, taken (and source, copies) of every document."""
    rows = written(measured(docs), "mix-rows")
    found = joined_rows(rows, decided(rows, weights))
    return found.select(
        "doc_id",
        "size",
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("size") * F.col("_mix_copies")).alias("taken"),
        "source",
        F.col("_mix_copies").alias("copies"),
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns."""
    plan = decided(written(measured(docs), "mix-rows"), weights).filter("copies > 0")
    names = [F.col(f"_row.`{c.replace('`', '``')}`").alias(c) for c in docs.columns]
    rows = docs.select(
        F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "source",
        F.xxhash64("text").alias("digest"),
    )
    found = joined_rows(rows, plan)
    return found.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_mix_copies"))).alias("_copy")).select(*names)
