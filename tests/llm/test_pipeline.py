"""The pipeline's stages on the smallest tables, each against plain Python, and the registered queries with SQL."""

from __future__ import annotations

import collections

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from bazaarspark.checks.compare import rows_of, tables
from bazaarspark.llm import cube_mixing, ftrl_quality, unit_dedup
from bazaarspark.llm.common import labelled_sample, table, written
from bazaarspark.llm.registry import llm_queries
from bazaarspark.llm.wildcard_simhash import fingerprint
from tests.llm.test_duplicates import smallest

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, q in llm_queries().items() if q.sql])
def test_queries_match_sql(spark, name):
    query = llm_queries()[name]
    df, cursor = query.run(spark, SMALL), tables(SMALL).execute(query.sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, map(tuple, df.collect())) == rows_of(names, cursor.fetchall())


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages) and len(stages) == 5
    run = [written(docs, "stage")]
    for stage in stages.values():
        run.append(written(stage(spark, run[-1], SMALL), "stage"))
    before, good, single, cut, mix, out = run
    for step in (good, single, cut, mix):
        assert step.columns == docs.columns

    labels = table(spark, SMALL, "labels")
    rows = before.collect()
    weights = ftrl_quality.trained(labelled_sample(before, labels, "quality", ~ftrl_quality.held_out(), ftrl_quality.SAMPLE))
    scores = ftrl_quality.scores([r["text"] for r in rows], weights)
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r, s in zip(rows, scores) if s >= 0.5}

    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    fps = {i: fingerprint(t.encode()) for i, t in texts.items()}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= corpus_pipeline.DISTANCE]
    assert {r["doc_id"] for r in single.collect()} == set(smallest(fps, near).values())

    seen = set()
    got = {r["doc_id"]: r for r in cut.collect()}
    for r in sorted(single.collect()):
        places = []
        for place, (_, _, words) in enumerate(unit_dedup.units(r["text"])):
            places += [place] if tuple(words) in seen else []
            seen.add(tuple(words))
        spans = unit_dedup.removed_spans(r["text"], places, "sentence", unit_dedup.MIN_WORDS)
        assert got[r["doc_id"]]["text"] == unit_dedup.without(r["text"], spans)
        assert got[r["doc_id"]]["n_chars"] == len(got[r["doc_id"]]["text"])
    assert len(got) == single.count()

    copies = {r["doc_id"]: r["copies"] for r in cube_mixing.mixing_plan(cut).collect()}
    taken = collections.Counter(r["doc_id"] for r in mix.collect())
    assert {i: n for i, n in copies.items() if n} == dict(taken)

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    mixed = {r["doc_id"]: r["text"] for r in mix.collect()}
    assert out.count() == mix.count()
    for r in out.collect():
        ids = [*library.encode(mixed[r["doc_id"]]), library.eos_id()]
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids) and r["text"] == library.decode(ids)
