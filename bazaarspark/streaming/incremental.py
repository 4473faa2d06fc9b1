"""Aggregates of a stream kept up to date by partial results of its micro-batches.

A micro-batch is reduced to a partial result (sums by day, sessions of its own events, newest readings), which is written to
a folder named by the batch's number: a batch that is retried replaces its own folder and counts once. The state is the
merge of all parts, so rows that come late, for any day, only add a part. Parts are folded from time to time: one base holds
everything up to a batch, and later parts stand beside it. Nothing is kept in the stream's state store, and a reader sees
complete folders only.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarspark.sources.store import deleted

FOLD = 32  # parts beside the base before they are folded


@dataclasses.dataclass(frozen=True)
class Aggregate:
    """How rows become a partial result, and how partial results, old and new, become one. `merge` may be applied again."""

    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


def grouped(keys: Mapping[str, str], measures: Mapping[str, tuple[str, str]]) -> Aggregate:
    """Measures by keys, given as SQL: name to expression, and name to (aggregate of rows, aggregate of its parts)."""

    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*(F.expr(e).alias(k) for k, e in keys.items())).agg(*(F.expr(p).alias(m) for m, (p, _) in measures.items()))

    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy(*keys).agg(*(F.expr(f"{how}(`{m}`)").alias(m) for m, (_, how) in measures.items()))

    return Aggregate(partial, merge)


def total(expression: str) -> tuple[str, str]:
    return f"sum({expression})", "sum"


def rows_where(condition: str = "true") -> tuple[str, str]:
    return f"count_if({condition})", "sum"


def least(expression: str) -> tuple[str, str]:
    return f"min({expression})", "min"


def greatest(expression: str) -> tuple[str, str]:
    return f"max({expression})", "max"


def distinct_sketch(expression: str) -> tuple[str, str]:
    """A mergeable sketch of distinct values; read it with `hll_sketch_estimate`."""
    return f"hll_sketch_agg({expression})", "hll_union_agg"


def newest(time: str, value: str) -> tuple[str, str]:
    """struct(time, value) of the newest reading; the greater value of two at one time."""
    return f"max(struct({time} AS time, {value} AS value))", "max"


def sessions(user: str, time: str, gap: str, value: str) -> Aggregate:
    """Sessions of a user: events closer than `gap`. Sessions of parts are merged where they come closer than `gap`.

    (user, first, last, events, value). An event that falls between two sessions joins them, however late it comes. The
    events of a user are joined day by day first: of a user with very many, at most as many sessions as fit into the days
    come together.
    """

    def joined(rows: DataFrame, *within: str) -> DataFrame:
        by_user = Window.partitionBy("user", *within)
        before = by_user.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
        reach = F.max("last").over(before) + F.expr(f"INTERVAL {gap}")
        new = F.coalesce(F.col("first") >= reach, F.lit(True)).cast("int")
        numbered = rows.withColumn("new", new).withColumn("session", F.sum("new").over(by_user.orderBy("first", "last")))
        return (
            numbered.groupBy("user", "session", *within)
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("events").alias("events"), F.sum("value").alias("value"))
            .drop("session", *within)
        )

    def partial(rows: DataFrame) -> DataFrame:
        found = rows.select(F.col(user).alias("user"), F.col(time).alias("first"), F.col(time).alias("last"), F.col(value).alias("value"))
        # Events of a user at one moment are one row before anything is ordered.
        found = found.groupBy("user", "first", "last").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
        found = found.select("user", "first", "last", "events", "value", F.to_date("first").alias("day"))
        return joined(joined(found, "day"))

    return Aggregate(partial, joined)


def _complete(spark: SparkSession, place: str, kind: str) -> dict[int, str]:
    """Number -> folder of the complete bases or parts."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(f"{place}/{kind}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    done = [n for n in names if fs.exists(path(f"{place}/{kind}/{n}/_SUCCESS"))]
    return {int(n.partition("-")[2]): f"{place}/{kind}/{n}" for n in done if n.startswith("batch-")}


def _folders(spark: SparkSession, place: str) -> tuple[int, list[str]]:
    """The last batch in the newest base (-1: no base), and the folders that make the state."""
    bases, parts = _complete(spark, place, "base"), _complete(spark, place, "parts")
    upto = max(bases, default=-1)
    return upto, [*([bases[upto]] if bases else []), *(f for n, f in sorted(parts.items()) if n > upto)]


def state(spark: SparkSession, place: str, aggregate: Aggregate) -> DataFrame:
    """The aggregate over everything the stream has brought so far."""
    _, folders = _folders(spark, place)
    if not folders:
        raise ValueError(f"no batch under {place}")
    return aggregate.merge(spark.read.parquet(*folders))


def add(batch: DataFrame, number: int, place: str, aggregate: Aggregate, fold: int = FOLD) -> None:
    """Write the partial result of a batch; a batch that the base holds already adds nothing."""
    spark = batch.sparkSession
    if number <= _folders(spark, place)[0]:
        return
    aggregate.partial(batch).write.mode("overwrite").parquet(f"{place}/parts/batch-{number:012d}")
    parts = _complete(spark, place, "parts")
    upto = max(_complete(spark, place, "base"), default=-1)
    if sum(n > upto for n in parts) > fold:
        folded(spark, place, aggregate)


def folded(spark: SparkSession, place: str, aggregate: Aggregate) -> None:
    """Merge base and parts into a new base. What the base before was made from goes; its own parts stay for readers."""
    upto, folders = _folders(spark, place)
    parts, bases = _complete(spark, place, "parts"), _complete(spark, place, "base")
    last = max(parts)
    state(spark, place, aggregate).write.mode("overwrite").parquet(f"{place}/base/batch-{last:012d}")
    for kind, known in (("parts", parts), ("base", bases)):
        for n in known:
            if n < upto or (kind == "parts" and n == upto):
                deleted(spark, known[n])


def maintained(stream: DataFrame, place: str, checkpoint: str, aggregate: Aggregate, fold: int = FOLD) -> StreamingQuery:
    """Keep the aggregate of a stream under `place`: everything there is now, in micro-batches, then stop."""
    return (
        stream.writeStream.foreachBatch(lambda batch, number: add(batch, number, place, aggregate, fold))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_orders(keys: Sequence[str] = ("platform",)) -> Aggregate:
    """Orders, revenue, cancellations and customers by day and `keys`, of staging orders."""
    return grouped(
        {"date": "to_date(order_date)", **{k: k for k in keys}},
        {
            "orders": rows_where(),
            "cancelled": rows_where("status = 'cancelled'"),
            "revenue": total("total"),
            "least_total": least("total"),
            "greatest_total": greatest("total"),
            "customers": distinct_sketch("customer_id"),
        },
    )


def realtime_users() -> Aggregate:
    """Newest number of active users by property, country and city, of `realtime_rows` with `taken_at`."""
    keys = {c: c for c in ("property_id", "country", "city")}
    return grouped(keys, {"reading": newest("taken_at", "active_users"), "readings": rows_where()})
