"""Sharding by extendible hashing.

A document's hash is the first 60 bits of md5 over its id and text. A bucket is a prefix of hash bits; only buckets that
hold more bytes than a shard may are split on another bit, until each fits. Sums are taken for `STEP` bits at a time,
in rounds that read only what is still too large; all that is kept between rounds is the directory, whose size is the
number of shards. A bucket of rows that agree in all bits (copies of one document) cannot be split by hash: its rows are
dealt in order, as many to a part as fit. One document larger than a shard is a part of its own.

Defined results: null and empty texts have no bytes and still have a shard; a null id hashes like the empty text; rows
with the same id and text share a bucket, and parts if they are too many; other columns stay in `sharded`; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarspark.llm.common import quoted, removed, written

LIMIT = 16 << 20  # bytes of text in a shard
BITS = 60
STEP = 8
PIECE_BITS = 16  # copies that one task numbers: 2 to this power


def hash_of() -> Column:
    """The document's hash, below 2^60."""
    identity = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(identity.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, bytes, hash) of every document."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), size.alias("bytes"), hash_of().alias("hash"))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, whole): the buckets; `whole` is false where copies of one document exceed the limit."""
    found, depth, left = None, 0, rows.select("hash", "bytes")
    while True:
        deep = min(depth + STEP, BITS)
        sums = left.groupBy(F.shiftright("hash", BITS - deep).alias("deep")).agg(
            F.sum("bytes").alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        levels = F.explode(F.sequence(F.lit(depth), F.lit(deep))).alias("depth")
        sums = sums.select("deep", "bytes", "low", "high", levels)
        shift = F.expr(f"shiftright(deep, {deep} - depth)")
        sums = sums.groupBy("depth", shift.alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high")
        )
        fits = (F.col("bytes") <= limit) | (F.col("low") == F.col("high"))
        sums = written(sums.withColumn("fits", fits), "shard-sums")
        parent = sums.select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"), F.col("fits").alias("above_fits")
        )
        at = [sums.depth == parent.depth, F.expr("shiftright(prefix, 1)") == parent.above]
        leaf = sums.join(parent, at, "left").filter(F.col("fits") & ~F.coalesce("above_fits", F.lit(False)))
        leaf = leaf.select(sums.depth, "prefix", (F.col("bytes") <= limit).alias("whole"))
        found = leaf if found is None else found.union(leaf)
        over = sums.filter((F.col("depth") == deep) & ~F.col("fits")).select(F.col("prefix").alias("over"))
        if over.isEmpty():
            return found
        left = left.join(over, F.shiftright("hash", BITS - deep) == F.col("over"), "left_semi")
        depth = deep


def placed(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """The rows with depth, prefix and whole of their bucket. The depths in use, 61 numbers at most, are collected."""
    depths = sorted(r["depth"] for r in leaves.select("depth").distinct().collect())
    each = F.explode(F.array(*(F.lit(d) for d in depths)) if depths else F.array().cast("array<int>"))
    rows = rows.select("*", each.alias("_depth"))
    rows = rows.withColumn("_prefix", F.expr(f"shiftright(hash, {BITS} - _depth)"))
    return rows.join(leaves, [rows["_depth"] == leaves.depth, rows["_prefix"] == leaves.prefix]).drop("_depth", "_prefix")


def with_parts(rows: DataFrame, limit: int) -> DataFrame:
    """The rows of `placed` with `part`: 0 in a bucket that fits; copies beyond the limit are dealt in order.

    They are numbered in pieces of at most 2^`PIECE_BITS` rows, shifted by the sizes of the pieces before.
    """
    whole = rows.filter("whole").withColumn("part", F.lit(0).cast("bigint"))
    many = rows.filter("NOT whole").withColumn("_piece", F.shiftright(F.monotonically_increasing_id(), PIECE_BITS))
    # Written, so that every reader sees the same pieces.
    many = written(many, "shard-copies")
    if many.isEmpty():
        removed(many)
        return whole
    key = ["depth", "prefix"]
    ahead = Window.partitionBy(*key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = many.groupBy(*key, "_piece").agg(F.count("*").alias("_n"))
    pieces = pieces.select(*key, "_piece", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("_bytes", F.lit(1))))
    number = F.row_number().over(Window.partitionBy(*key, "_piece").orderBy(F.lit(0)))
    many = many.withColumn("_number", number).join(pieces, [*key, "_piece"])
    many = many.withColumn("part", F.floor((F.col("_ahead") + F.col("_number") - 1) / fit))
    return whole.unionByName(many.drop("_piece", "_number", "_ahead"))


def shard_rows(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, bytes, depth, prefix, part, shard of every document."""
    rows = written(hashed(docs), "shard-rows")
    found = placed(rows.withColumn("_bytes", F.col("bytes")), written(directory(rows, limit), "shard-directory"))
    name = F.concat_ws("-", "depth", "prefix", "part").alias("shard")
    return with_parts(found, limit).select("doc_id", "bytes", "depth", "prefix", "part", name)


def write_shards(docs: DataFrame, folder: str, limit: int = LIMIT) -> None:
    """The documents in one folder for each shard, `folder`/shard=depth-prefix-part."""
    sizes = written(hashed(docs).select("hash", "bytes"), "shard-rows")
    leaves = written(directory(sizes, limit), "shard-directory")
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    # The documents as one column: theirs may have any names.
    rows = docs.select(
        F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("_row"), hash_of().alias("hash"), size.alias("_bytes")
    )
    found = with_parts(placed(rows, leaves), limit)
    name = F.concat_ws("-", "depth", "prefix", "part").alias("shard")
    found.select("_row.*", name).repartition("shard").write.partitionBy("shard").parquet(folder)
    removed(sizes)
    removed(leaves)


SQL = f"""
WITH RECURSIVE rows AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS bytes,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS hash
    FROM documents
), sums AS (
    SELECT d.depth, rows.hash >> (60 - d.depth) AS prefix, sum(bytes) AS bytes, min(hash) = max(hash) AS one
    FROM rows CROSS JOIN (SELECT CAST(unnest(range(0, 61)) AS INTEGER) AS depth) d
    GROUP BY ALL
), leaves AS (
    SELECT depth, prefix, bytes <= {LIMIT} AS whole FROM sums WHERE depth = 0 AND (bytes <= {LIMIT} OR one)
    UNION ALL
    SELECT s.depth, s.prefix, s.bytes <= {LIMIT}
    FROM sums s JOIN sums p ON p.depth = s.depth - 1 AND p.prefix = s.prefix >> 1
    WHERE (s.bytes <= {LIMIT} OR s.one) AND p.bytes > {LIMIT} AND NOT p.one
), placed AS (
    SELECT doc_id, bytes, depth, prefix,
           CASE WHEN whole THEN 0
                ELSE (row_number() OVER (PARTITION BY depth, prefix ORDER BY hash) - 1)
                     // greatest(1, {LIMIT} // greatest(bytes, 1)) END AS part
    FROM rows JOIN leaves ON leaves.prefix = rows.hash >> (60 - leaves.depth)
)
SELECT doc_id, CAST(bytes AS BIGINT) AS bytes, depth, prefix, CAST(part AS BIGINT) AS part,
       depth || '-' || prefix || '-' || CAST(part AS BIGINT) AS shard
FROM placed
"""
