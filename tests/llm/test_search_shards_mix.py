"""Exact search, sharding and mixing against brute force and their own rules."""

from __future__ import annotations

import collections
import math
import re

import duckdb
import numpy as np
import pytest

from bazaarspark.llm import block_search, cube_mixing, extendible_shards
from bazaarspark.llm.common import shared_folder
from tests.llm.helpers import DOCS, empty_docs, hard_docs, rows_of, text, with_clashes
from tests.llm.test_duplicates import usable, vectors


def test_top_k_against_brute_force(spark):
    rows, df = vectors(spark)
    whole = [(i, [math.floor(256 * c) for c in v]) for i, v, _ in rows if i is not None and usable(v)]
    want = []
    for query_id, q in {(i, tuple(v)) for i, v in whole if i % 50 == 0}:
        scored = [(-sum(a * b for a, b in zip(q, v)), i) for i, v in whole if i != query_id and len(v) == len(q)]
        cut = lambda s: max(-(2**63), min(2**63 - 1, s))
        want += [(query_id, k + 1, i, cut(-s)) for k, (s, i) in enumerate(sorted(scored)[:5])]
    assert rows_of(block_search.top_k(df)) == sorted(want, key=repr)
    assert block_search.top_k(df.filter("vec_id < -1")).collect() == []


def test_blocks_are_left_out():
    rng = np.random.default_rng(2)
    x = np.repeat(rng.standard_normal((20, 8)), 64, axis=0) + 0.01 * rng.standard_normal((1280, 8))
    import pyarrow as pa

    shard = block_search.Shard(np.arange(1280), pa.array(x.tolist()))
    seen = []
    rows = shard.rows

    class Watched:
        shape = rows.shape

        def __getitem__(self, at):
            seen.append(len(at))
            return rows[at]

    shard.rows = Watched()
    q = rows[0]
    ids, scores = shard.top(0, q, 8, 5)
    order = np.lexsort((np.arange(1, 1280), -(rows[1:] @ q)))[:5] + 1
    assert ids.tolist() == order.tolist() and sum(seen) < 640


@pytest.mark.parametrize("limit", [400, 5000, 1 << 24])
def test_shards_fit(spark, limit):
    docs = spark.createDataFrame([(i, text(i, 10 + i % 90), "en", "a", 1) for i in range(300)] + [(5000, "x" * 300, "e", "a", 1)] * 40, DOCS)
    docs = with_clashes(hard_docs(spark).union(docs))
    found = extendible_shards.shard_rows(docs, limit).collect()
    assert len(found) == docs.count()
    sums, sizes = collections.Counter(), collections.defaultdict(list)
    for r in found:
        sums[r["shard"]] += r["bytes"]
        sizes[r["shard"]].append(r["bytes"])
    assert all(n <= limit or len(sizes[s]) == 1 for s, n in sums.items())
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    con.execute("CREATE TABLE d AS SELECT CAST(doc_id AS BIGINT) doc_id, text FROM documents")
    sql = extendible_shards.SQL.replace(str(extendible_shards.LIMIT), str(limit)).replace("FROM documents", "FROM d")
    assert sorted(map(tuple, found), key=repr) == sorted(con.execute(sql).fetchall(), key=repr)


def test_shards_are_written(spark):
    docs = spark.createDataFrame([(i, text(i), "en", "a", 1) for i in range(60)], DOCS)
    folder = shared_folder(spark, "shards")
    extendible_shards.write_shards(docs, folder, 4000)
    back = spark.read.parquet(folder)
    assert rows_of(back.select(docs.columns)) == rows_of(docs) and back.select("shard").distinct().count() > 5
    assert extendible_shards.shard_rows(empty_docs(spark)).collect() == []


def test_targets():
    assert cube_mixing.targets([100, 100, 100]) == pytest.approx([187.5, 75.0, 37.5])
    # Beyond three times its size, a source's excess goes to the others by weight, again until none is above.
    assert cube_mixing.targets([10, 100, 1000]) == pytest.approx([30.0, 300.0, 780.0])
    assert cube_mixing.targets([0, 0]) == [0.0, 0.0] and cube_mixing.targets([7]) == [7.0]


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(4)
    size = rng.integers(1, 900, 500).astype(float).tolist()
    p = rng.random(500).tolist()
    count = [1.0] * 500
    before = sum(p), float(np.dot(p, size))
    cube_mixing.flight(p, size, count, iter(rng.random(5000).tolist()).__next__)
    assert sum(p) == pytest.approx(before[0], abs=1e-4) and float(np.dot(p, size)) == pytest.approx(before[1], abs=0.1)
    assert sum(1e-6 < x < 1 - 1e-6 for x in p) <= 2


@pytest.mark.parametrize("units", [30, 20_000])
def test_mix_comes_near_its_targets(spark, units, monkeypatch):
    monkeypatch.setattr(cube_mixing, "UNITS", units)
    rows = [(i, text(i, 10 + 10 * (i % 9)), "en", f"s{i % 4}" if i % 3 else "s0", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    plan = cube_mixing.mixing_plan(docs)
    found = plan.collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, cube_mixing.mixing_plan(docs.repartition(5)).collect()))
    taken, target = collections.Counter(), {}
    for r in found:
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in found))
    assert all(abs(taken[s] - t) <= 100 for s, t in target.items())
    mixed = cube_mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert sum(len(r["text"].split()) for r in mixed.collect()) == sum(taken.values())


def test_mix_of_hard_documents(spark):
    docs = with_clashes(hard_docs(spark))
    found = cube_mixing.mixing_plan(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
    sizes = {(r["doc_id"], r["size"]) for r in found}
    assert sizes == {(r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()}
    assert cube_mixing.mixed(docs).columns == docs.columns
    assert cube_mixing.mixing_plan(empty_docs(spark)).collect() == []
    assert cube_mixing.mixed(empty_docs(spark)).collect() == []
