"""Bounds that do not depend on the data: bytes of a sample, bytes of a shard, what a worker keeps."""

from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

from bazaarspark.llm import common, extendible_shards
from bazaarspark.llm.common import labelled_sample, shared_folder
from tests.llm.helpers import DOCS, rows_of, text, with_clashes


@pytest.mark.parametrize("budget, most", [(64 << 20, 12), (3_500_000, 12), (500_000, 12), (10, 12), (64 << 20, 4)])
def test_sample_keeps_its_bytes(spark, budget, most):
    """Texts of almost 1 MiB each, and small ones."""
    rows = [(i, f"{i} " + "x" * (1_000_000 if i % 2 else 100), "en", "a", 1) for i in range(12)]
    rows.append((12, "x" * (2 << 20), "en", "a", 1))
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    labels = spark.createDataFrame([(i, i % 3 % 2) for i in range(13)] + [(None, 1), (3, 1), (3, 1)], "doc_id bigint, quality int")
    found = labelled_sample(docs, labels, "quality", F.lit(True), most, most_bytes=budget)
    assert sum(len(t) for t, _ in found) <= budget and len(found) <= most
    assert found == labelled_sample(docs.repartition(3), labels, "quality", F.lit(True), most, most_bytes=budget)
    assert len(found) > 2 or budget < 1000
    assert labelled_sample(docs.limit(0), labels, "quality", F.lit(True), most) == []


@pytest.mark.parametrize("limit", [1_000, 2_500])
def test_written_shards_keep_their_limit(spark, limit, monkeypatch):
    """One document repeated far beyond three limits, in rows that several pieces number."""
    monkeypatch.setattr(extendible_shards, "PIECE_BITS", 2)
    rows = [(i, text(i, 20), "en", "a", i) for i in range(30)]
    rows += [(99, "r" * 300, "en", "a", i) for i in range(45)] + [(98, "y" * 4000, "en", "b", 0)] * 3
    docs = with_clashes(spark.createDataFrame(rows, DOCS)).repartition(5)
    folder = shared_folder(spark, "shards")
    extendible_shards.write_shards(docs.drop("shard"), folder, limit)
    back = spark.read.parquet(folder)
    assert rows_of(back.select(docs.drop("shard").columns)) == rows_of(docs.drop("shard"))
    sums, counts = collections.Counter(), collections.Counter()
    for r in back.select("shard", "text").collect():
        sums[r["shard"]] += len(r["text"].encode())
        counts[r["shard"]] += 1
    assert all(n <= limit or counts[s] == 1 for s, n in sums.items())
    listed = collections.Counter(r["shard"] for r in extendible_shards.shard_rows(docs, limit).collect())
    assert counts == listed


def test_workers_keep_the_table_of_one_work():
    made = []

    def table(name):
        made.append(name)
        return [name]

    common.begin("one")
    assert common.kept(table, "a") is common.kept(table, "a") and made == ["a"]
    common.begin("one")
    common.kept(table, "a")
    common.begin("two")
    common.kept(table, "a")
    assert made == ["a", "a"]
    assert list(common.released(lambda batches: iter(batches))([1, 2])) == [1, 2]
