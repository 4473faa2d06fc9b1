"""The conversation trie against a plain walk over all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bazaarspark.llm import conversation_trie as module
from tests.llm.helpers import rows_of

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest(role: str, text: str) -> str:
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plainly(rows, share_starts: bool):
    """The nodes by the rule, from (conv_id, turn, role, text) rows."""
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            convs[conv_id].append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    given = {c: [t for _, _, t in sorted(turns)] for c, turns in convs.items()}
    paths = {}
    for c, turns in given.items():
        h = zlib.crc32(str(c).encode()) % 9 if share_starts else 0
        paths[c] = given.get(c - c % 5, [])[:h] + turns[h:] if share_starts else turns
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in children[node]]
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        sums[node] = (own + sum(s for s, _ in below), sum(n for _, n in below) or 1)
    found = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        saved, leaves = sums[node]
        sha = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(ids), len(node), parent, len(ids), len(children[node]), leaves, saved, sha))
    return sorted(found, key=repr)


def some(seed: int, conversations: int, longest: int, words: int):
    """Conversations that share starts of all lengths, with copies and repeated turns."""
    rng = random.Random(seed)
    rows = []
    made = []
    for c in range(conversations):
        if made and rng.random() < 0.7:
            base = rng.choice(made)
            path = base[: rng.randint(0, len(base))] if rng.random() < 0.7 else list(base)
        else:
            path = []
        if rng.random() < 0.7:
            path = path + [(rng.choice("ua"), f"w{rng.randrange(words)}é") for _ in range(rng.randint(0, longest))]
        made.append(path)
        rows += [(c, i, role, text) for i, (role, text) in enumerate(path)]
    rng.shuffle(rows)
    return rows


HARD = [
    (None, 1, "u", "lost"),
    (10, None, None, None),
    (10, None, "u", None),
    (10, 1, "u", "same"),
    (10, 1, "u", "same"),
    (10, 1, "a", "tie"),
    (11, 0, "u", "x" * 200_000),
    (12, 0, "u", "x" * 200_000),
    (12, 1, "", ""),
    (13, 1, "u:", "v"),
    (14, 1, "u", ":v"),
    (-7, 5, "u", "below zero"),
    (4100, 5, "u", "below zero"),
]


@pytest.mark.parametrize("share_starts", [False, True])
@pytest.mark.parametrize("block, segment", [(8, 1 << 10), (2, 3)])
def test_tries_equal_the_walk(spark, monkeypatch, share_starts, block, segment):
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "SEGMENT", segment)
    monkeypatch.setattr(module, "ENDS", 2)
    rows = some(block, 60, 25, 2)
    found = module.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), share_starts)
    assert rows_of(found) == plainly(rows, share_starts)


def test_hard_rows_and_clashing_names(spark):
    table = spark.createDataFrame(HARD, SCHEMA)
    names = ("a", "block", "digest", "bytes", "pos", "part", "length", "saved", "depth", "base", "h")
    table = table.select("*", *(F.lit("x").alias(n) for n in names))
    # With starts shared, -7 has another base in Python than in SQL: c - c % 5 is towards zero there.
    assert rows_of(module.conversation_trie(table)) == plainly(HARD, False)
    rest = [r for r in HARD if r[0] is None or r[0] >= 0]
    found = module.conversation_trie(table.filter("conv_id IS NULL OR conv_id >= 0"), share_starts=True)
    assert rows_of(found) == plainly(rest, True)


def test_one_conversation_in_many_parts(spark):
    """A conversation that several tasks hold, with all turns equal, and copies of another one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(7, None, "u", "again")] * 300 + [(c, t, "u", f"t{t}") for c in range(20, 90) for t in range(3)]
        turns = module.ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(4))
        assert turns.filter("conv_id = 7").select("part").distinct().count() > 1
        found = module.trie(*module.as_given(turns, module.spans_of(turns)))
        assert rows_of(found) == plainly(rows, False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_table_and_turnless_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert module.conversation_trie(empty, share_starts=True).collect() == []
    # 1 and 2 have no base and fewer turns than they lose.
    rows = [(c, 0, "u", "a") for c in (1, 2, 3, 4, 6)]
    found = module.conversation_trie(spark.createDataFrame(rows, SCHEMA), share_starts=True)
    assert rows_of(found) == plainly(rows, True)
