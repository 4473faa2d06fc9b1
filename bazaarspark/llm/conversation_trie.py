"""Prefix trie of conversations by fixed-length block hashing.

The turns of a conversation are cut into blocks of `BLOCK`. A block's digest and the digests of the blocks before it name
the node that the block starts from; conversations are first grouped by (start, block digest), which costs one row for
each block and combines copies before the shuffle. Only where several different blocks follow one start, their turn
boundaries are refined: each of those distinct blocks is spread into its prefixes, which are grouped again with the
counts of their blocks. A block that has no sibling needs no refinement: all its turns have its members.

A node is named by its depth and four sums of 32-bit parts of the digests of its blocks and of its last, partial block, so
names of the starts are running sums, and a conversation of any length is summed in parts of `SEGMENT` blocks.

Sums over subtrees need no walk through the trie. A node belongs to its smallest member, its owner; the nodes of an owner
are the last ones of its path, and every node below one's path belongs to a member. So the sum over a subtree is the sum
over its members of what they own, less what the owner owns above the node: two more sums of the same kind.

The ids of the conversations that end at a node are joined in pieces of at most 4,096 ids, then digested piece by piece.
SHA-256 reads its bytes in order, so the pieces of one node pass through one task, one at a time and never held together.

Defined results: a null role or text is empty; turns are ordered by turn (null first), then by a digest of role and
text; repeated rows are repeated turns; rows without conv_id are in no conversation; a conversation without turns (it can
become so by `rebuilt`) is a member of the root; texts of any length count whole; other columns are not read; an empty
table has no node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarspark.llm.common import arrow, crc32_of, removed, written

BLOCK = 8  # turns
SEGMENT = 1 << 10  # blocks that are summed together
ENDS = 12  # bits of a conv_id within a piece of ids
FAMILY, STARTS = 5, 9  # `rebuilt`: conversations that share a start, lengths of it
SUMS = ("a", "b", "c", "d")
NODE = ("depth", *SUMS)
EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, local, digest, bytes): turns numbered from 1 inside the part of a conversation that a task had.

    All rows are parted by range, so a conversation of any length, even of equal rows, is spread over tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length first: no two different turns are written alike.
    content = F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.unhex(F.md5(content.cast("binary"))).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = (F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("digest").asc(), F.col("row").asc())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "bytes")

    def work(batches):
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            new = np.r_[ids[0] != last, ids[1:] != ids[:-1]]
            first = np.flatnonzero(new)
            at = np.arange(len(ids))
            local = at - np.r_[0, first][np.cumsum(new)] + 1
            local[: first[0] if len(first) else len(ids)] += count
            last, count = ids[-1], local[-1]
            parts = pa.array(np.full(len(ids), part, np.int32))
            yield pa.record_batch(
                [batch.column("conv_id"), parts, pa.array(local.astype(np.int64)), batch.column("digest"), batch.column("bytes")],
                ["conv_id", "part", "local", "digest", "bytes"],
            )

    return written(arrow(rows, work, "conv_id bigint, part int, local bigint, digest binary, bytes bigint"), "turns")


def spans_of(turns: DataFrame) -> DataFrame:
    """(conv_id, part, ahead, total): turns of the conversation in earlier parts, and in all."""
    within = Window.partitionBy("conv_id")
    ahead = within.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = turns.groupBy("conv_id", "part").agg(F.max("local").alias("n"))
    spans = spans.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    return spans.withColumn("total", F.sum("n").over(within)).drop("n")


def as_given(turns: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns (conv_id, pos, digest, bytes, length) and conversations (conv_id, length) as they are."""
    placed = turns.join(spans, ["conv_id", "part"])
    placed = placed.select(
        "conv_id", (F.col("local") + F.col("ahead") - 1).alias("pos"), "digest", "bytes", F.col("total").alias("length")
    )
    return placed, spans.select("conv_id", F.col("total").alias("length")).distinct()


def rebuilt(turns: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As `as_given`, with the first turns of a conversation c replaced by those of c - c % FAMILY: as many as crc32(c) % STARTS."""
    base, h = F.col("conv_id") - F.col("conv_id") % FAMILY, crc32_of("conv_id") % STARTS
    totals = spans.select(F.col("conv_id").alias("base"), F.col("total").alias("base_total")).distinct()
    known = spans.withColumn("base", base).withColumn("h", h).join(totals, "base", "left")
    known = known.withColumn("shared", F.least("h", F.coalesce("base_total", F.lit(0))))
    length = F.col("shared") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    known = written(known.withColumn("length", length), "conversation-parts")
    placed = turns.join(known, ["conv_id", "part"]).withColumn("pos", F.col("local") + F.col("ahead") - 1)
    own = placed.filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "digest", "bytes", "length"
    )
    # The starts that others take: at most STARTS - 1 turns.
    heads = placed.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < STARTS - 1))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("head")
    )
    convs = known.select("conv_id", "base", "shared", "length").distinct()
    taken = convs.filter("shared > 0").join(heads, "base")
    taken = taken.select("conv_id", "length", F.explode(F.slice("head", F.lit(1), F.col("shared").cast("int"))).alias("t"))
    taken = taken.select("conv_id", "t.pos", "t.digest", "t.bytes", "length")
    return own.unionByName(taken), convs.select("conv_id", "length")


def joined_bytes(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda whole, x: F.concat(whole, x))


def parts_of(digest: Column, block: Column) -> list[Column]:
    """Four 32-bit numbers from the digest of some turns of a block and the block's number."""
    h = F.md5(F.concat(digest, F.encode(block.cast("string"), "UTF-8")))
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(len(SUMS))]


def running(rows: DataFrame, by: str, at: str, values: dict[str, str], size: int) -> DataFrame:
    """Add {sum before: value} of the rows of `by` with a smaller `at`, in segments of `size`."""
    segment = F.floor(F.col(at) / size).alias("segment")
    within = Window.partitionBy(by, "segment").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", segment)
    local = rows.select("*", *(F.coalesce(F.sum(v).over(within), F.lit(0)).alias(n) for n, v in values.items()))
    if rows.filter("segment > 0").isEmpty():
        return local.drop("segment")
    ahead = Window.partitionBy(by).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.groupBy(by, "segment").agg(*(F.sum(v).alias(n) for n, v in values.items()))
    whole = whole.select(by, "segment", *(F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"ahead_{n}") for n in values))
    found = local.join(whole, [by, "segment"])
    kept = [c for c in local.columns if c not in (*values, "segment")]
    return found.select(*kept, *((F.col(n) + F.col(f"ahead_{n}")).alias(n) for n in values))


def blocks_of(turns: DataFrame) -> DataFrame:
    """(conv_id, block, digest, digests, bytes, ended, a, b, c, d): the blocks with the sums that name their start."""
    cut = turns.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("turns"),
        F.bool_or(F.col("pos") == F.col("length") - 1).alias("ended"),
    )
    cut = cut.select("conv_id", "block", "turns.digest", "turns.bytes", "ended").withColumnRenamed("digest", "digests")
    cut = cut.withColumn("digest", F.unhex(F.md5(joined_bytes(F.col("digests")))))
    parts = parts_of(F.col("digest"), F.col("block"))
    cut = written(cut.select("*", *(p.alias(f"own_{n}") for n, p in zip(SUMS, parts))), "blocks")
    found = running(cut, "conv_id", "block", {n: f"own_{n}" for n in SUMS}, SEGMENT)
    return written(found, "named-blocks")


def spread(groups: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Nodes of the grouped blocks: their names, their parents' names, bytes of the last turn, and the groups' values.

    `sums` says how the values of sibling blocks that share a prefix become one. Only blocks with siblings are grouped.
    """
    start = [F.col("block").alias("start_block"), *(F.col(n).alias(f"start_{n}") for n in SUMS)]
    siblings = groups.groupBy(*start).agg((F.count("*") > 1).alias("siblings"))
    same = [F.col("block") == F.col("start_block"), *(F.col(n) == F.col(f"start_{n}") for n in SUMS)]
    found = groups.join(siblings, same)
    length = F.sequence(F.lit(1), F.size("digests"))
    named = F.transform(
        length,
        lambda j: F.struct(
            j.alias("j"),
            F.get(F.col("bytes"), j - 1).alias("bytes"),
            F.struct(
                *(
                    (F.col(n) + p).alias(n)
                    for n, p in zip(
                        SUMS, parts_of(F.unhex(F.md5(joined_bytes(F.slice("digests", F.lit(1), j)))), F.col("block"))
                    )
                )
            ).alias("name"),
        ),
    )
    found = found.withColumn("turns", named).withColumn("turn", F.explode("turns"))
    above = F.when(F.col("turn.j") == 1, F.struct(*SUMS)).otherwise(F.get(F.col("turns"), F.col("turn.j") - 2)["name"])
    nodes = found.select(
        (F.col("block") * BLOCK + F.col("turn.j")).alias("depth"),
        *(F.col(f"turn.name.{n}").alias(n) for n in SUMS),
        *(above[n].alias(f"above_{n}") for n in SUMS),
        F.col("turn.bytes").alias("bytes"),
        *sums,
        "siblings",
    )
    alone = nodes.filter("not siblings").drop("siblings")
    refined = nodes.filter("siblings").groupBy(*NODE).agg(
        *(F.any_value(f"above_{n}").alias(f"above_{n}") for n in SUMS),
        F.any_value("bytes").alias("bytes"),
        *(how.alias(n) for n, how in sums.items()),
    )
    return alone.unionByName(refined)


def nodes_of(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """Every node: its name, its parent's sums, bytes, n_convs and its smallest member `conv_id`."""
    groups = blocks.groupBy("block", *SUMS, "digest").agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.any_value("digests").alias("digests"),
        F.any_value("bytes").alias("bytes"),
    )
    nodes = spread(groups, {"n_convs": F.sum("n_convs"), "conv_id": F.min("conv_id")})
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    root = root.select(
        "n_convs", "conv_id", zero.alias("bytes"), *(zero.alias(n) for n in NODE), *(none.alias(f"above_{n}") for n in SUMS)
    )
    return written(nodes.unionByName(root), "trie-nodes")


def ends_of(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """ends_sha256 of every node where a conversation ends."""
    last = [F.col(n) + F.col(f"own_{n}") for n in SUMS]
    depth = (F.col("block") * BLOCK + F.size("digests")).alias("depth")
    ends = blocks.filter("ended").select("conv_id", depth, *(x.alias(n) for x, n in zip(last, SUMS)))
    zero = F.lit(0).cast("bigint")
    ends = ends.unionByName(convs.filter("length = 0").select("conv_id", *(zero.alias(n) for n in NODE)))
    piece = F.shiftright("conv_id", ENDS).alias("piece")
    pieces = ends.groupBy(*NODE, piece).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select(*NODE, "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    schema = ", ".join(f"{n} bigint" for n in NODE) + ", ends_sha256 string"

    def work(batches):
        node, digest = None, None

        def made(rows):
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(NODE))]
            shas = pa.array([r[-1] for r in rows], pa.string())
            return pa.record_batch([*columns, shas], [*NODE, "ends_sha256"])

        for batch in batches:
            done = []
            for *name, ids in zip(*(batch.column(n).to_pylist() for n in (*NODE, "ids"))):
                if name == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = name, hashlib.sha256()
                digest.update(ids.encode())
            yield made(done)
        if node is not None:
            yield made([(*node, digest.hexdigest())])

    return arrow(pieces.select(*NODE, "ids"), work, schema)


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of conversations given as turns (conv_id, pos from 0, digest, bytes, length) and (conv_id, length)."""
    blocks = blocks_of(turns)
    nodes = nodes_of(blocks, convs)
    above = [f"above_{n}" for n in SUMS]
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *(F.col(f"above_{n}").alias(n) for n in SUMS))
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), list(NODE), "left")
    saved = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    nodes = written(nodes.fillna(0, ["n_children"]).select("*", saved), "trie-children")
    # What an owner has, and the sum of it over the members of each node.
    leaf = F.count_if(F.col("n_children") == 0).alias("n_leaves")
    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), leaf)
    owners = blocks.join(owned, "conv_id")
    groups = owners.groupBy("block", *SUMS, "digest").agg(
        F.sum("saved").alias("saved"),
        F.sum("n_leaves").alias("n_leaves"),
        F.any_value("digests").alias("digests"),
        F.any_value("bytes").alias("bytes"),
    )
    below = spread(groups, {"saved": F.sum("saved"), "n_leaves": F.sum("n_leaves")})
    below = below.select(*NODE, F.col("saved").alias("saved_below"), "n_leaves")
    whole = owned.agg(F.sum("saved").alias("saved_below"), F.sum("n_leaves").alias("n_leaves"))
    whole = whole.filter("n_leaves IS NOT NULL").select("*", *(F.lit(0).cast("bigint").alias(n) for n in NODE))
    nodes = running(nodes, "conv_id", "depth", {"saved_above": "saved"}, SEGMENT * BLOCK)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), *(F.col(n).alias(f"above_{n}") for n in SUMS), F.col("conv_id").alias("parent_conv_id")
    )
    found = nodes.join(below.unionByName(whole), list(NODE))
    found = found.join(parents, ["depth", *above], "left").join(ends_of(blocks, convs), list(NODE), "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("saved_below") - F.col("saved_above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, share_starts: bool = False) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    `share_starts` gives conversations of a family the same first turns before (`rebuilt`).
    """
    turns = ordered_turns(conversations)
    spans = written(spans_of(turns), "turn-spans")
    return trie(*(rebuilt if share_starts else as_given)(turns, spans))


SQL = f"""
WITH ordered AS (
    SELECT conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
           strlen(coalesce(text, '')) AS bytes,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), totals AS (
    SELECT conv_id, count(*) AS total FROM ordered GROUP BY conv_id
), convs AS (
    SELECT conv_id, conv_id - conv_id % {FAMILY} AS base,
           xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                     lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
               4294967295) % {STARTS} AS h
    FROM totals
), starts AS (
    SELECT c.conv_id, base, h, least(h, coalesce(total, 0)) AS shared
    FROM convs c LEFT JOIN totals t ON t.conv_id = c.base
), turns AS (
    SELECT s.conv_id, s.shared + o.pos - s.h AS pos, digest, bytes
    FROM starts s JOIN ordered o USING (conv_id) WHERE o.pos > s.h
    UNION ALL
    SELECT s.conv_id, o.pos, digest, bytes FROM starts s JOIN ordered o ON o.conv_id = s.base AND o.pos <= s.h
), paths AS (
    SELECT conv_id, pos AS depth, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY pos) AS node,
           string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above,
           bytes, pos = max(pos) OVER (PARTITION BY conv_id) AS ended
    FROM turns
    UNION ALL
    SELECT conv_id, 0, '', NULL, 0, conv_id NOT IN (SELECT conv_id FROM turns) FROM convs
), nodes AS (
    SELECT depth, node, CASE WHEN depth > 0 THEN coalesce(any_value(above), '') END AS above, any_value(bytes) AS bytes,
           count(*) AS n_convs, min(conv_id) AS conv_id,
           string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended) AS ends
    FROM paths GROUP BY depth, node
), children AS (
    SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), sized AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (depth, node)
), subtrees AS (
    SELECT p.depth, p.node, sum((u.n_convs - 1) * u.bytes) AS saved, count(*) FILTER (u.n_children = 0) AS n_leaves
    FROM sized u JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.depth, p.node
)
SELECT CAST(n.conv_id AS BIGINT) AS conv_id, CAST(n.depth AS BIGINT) AS depth, CAST(p.conv_id AS BIGINT) AS parent_conv_id,
       CAST(n.n_convs AS BIGINT) AS n_convs, CAST(n.n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM sized n JOIN subtrees USING (depth, node) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.above
"""
