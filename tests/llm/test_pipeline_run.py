"""The pipeline reads what the stage before it wrote, and takes the same row of several in any order."""

from __future__ import annotations

import corpus_pipeline
from bazaarspark.llm import wildcard_simhash
from tests.llm.helpers import DOCS, rows_of, text
from tests.llm.test_pipeline import SMALL


def test_stages_read_what_was_written(spark, monkeypatch):
    read = []

    def same(spark, docs, folder):
        read.append(docs.inputFiles())
        return docs

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", same), ("two", same)])
    out = corpus_pipeline.run(spark, SMALL)
    before, between = read
    assert all(f.startswith(f"file://{SMALL}/documents.parquet") for f in before)
    assert between and not set(between) & set(before) and not set(out.inputFiles()) & {*before, *between}
    assert out.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_the_row_that_stays_does_not_depend_on_order(spark):
    rows = [(i, text(i), "en", source, 1) for i in range(5) for source in "cab"]
    want = [(i, text(i), "en", "a", 1) for i in range(5)]
    for some in (rows, rows[::-1]):
        kept = wildcard_simhash.one_of_each(spark.createDataFrame(some, DOCS).coalesce(1))
        assert rows_of(kept) == sorted(want, key=repr)
