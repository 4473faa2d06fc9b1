"""SimHash, unit and embedding de-duplication, and components, against brute force."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pytest
import xxhash

from bazaarspark.llm import components, tile_neighbours, unit_dedup, wildcard_simhash
from tests.llm.helpers import DOCS, empty_docs, hard_docs, rows_of, sentence, text, with_clashes


def smallest(nodes, pairs):
    """Smallest node reachable from each node."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(200, 260)] + [(7000, 6000), (6000, 6500), (-5, 7000)]
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)
    want = smallest({n for e in edges for n in e}, edges)
    assert {r["node"]: r["component"] for r in components.components(df).collect()} == want
    assert components.components(df.filter("a < -100")).collect() == []


def plain_fingerprint(value, size=4):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), value or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    digests = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


@pytest.mark.parametrize("distance", [0, 4, 7])
def test_every_close_pair_shares_a_variant(distance):
    rng = np.random.default_rng(distance)
    for _ in range(300):
        a = int(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, distance, replace=False):
            b ^= 1 << int(bit)
        near = [
            (first, width)
            for first, width in wildcard_simhash.cuts(distance)
            if (((a ^ b) >> first) & ((1 << width) - 1)).bit_count() <= 1
        ]
        assert near


@pytest.mark.parametrize("tile", [4, 2048])
def test_simhash_against_brute_force(spark, tile, monkeypatch):
    base = text(3, 200)
    words = base.split()
    rows = [(i, " ".join(w if k != i * 3 else "changed" for k, w in enumerate(words)), "en", "a", 1) for i in range(60)]
    rows += [(100 + i, text(i + 50, 40), "en", "b", 1) for i in range(40)]
    docs = with_clashes(hard_docs(spark).union(spark.createDataFrame(rows, DOCS)))
    dealt = wildcard_simhash.dealt
    monkeypatch.setattr(wildcard_simhash, "dealt", lambda found: dealt(found, tile))
    found = wildcard_simhash.simhash_digest(docs).collect()
    every = docs.select("doc_id", "text").collect()
    fps = {plain_fingerprint(r["text"]) for r in every}
    group = smallest(fps, [(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 4])
    first = {}
    for r in every:
        g = group[plain_fingerprint(r["text"])]
        if r["doc_id"] is not None:
            first[g] = min(first.get(g, r["doc_id"]), r["doc_id"])
    want = [(r["doc_id"], f"{(f := plain_fingerprint(r['text'])):016x}", first.get(group[f])) for r in every]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    kept = wildcard_simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(group.values()))


def test_simhash_of_nothing(spark):
    assert wildcard_simhash.simhash_digest(empty_docs(spark)).collect() == []
    assert wildcard_simhash.one_of_each(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("unit", ["sentence", "line", "paragraph"])
def test_units_against_brute_force(spark, unit):
    passage = " ".join(sentence(900 + k, 12) for k in range(5))
    rows = [(20 + i, f"{text(20 + i)} {passage}\n\n{text(60 + i)}\n{passage}", "en", "a", 1) for i in range(6)]
    rows += [(40, "Yes. No. Yes. No.", "en", "a", 1), (41, "Yes. No.", "en", "a", 1)]
    docs = with_clashes(hard_docs(spark).union(spark.createDataFrame(rows, DOCS)))
    got = {(r["doc_id"], r["text"]): r for r in unit_dedup.unit_spans(docs, unit).collect()}
    seen, want = set(), set()
    tie = {r["text"]: r["tie"] for r in docs.selectExpr("coalesce(text, '') text", "xxhash64(coalesce(text, '')) tie").collect()}
    every = {(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()}
    for doc_id, value in sorted(every, key=lambda d: (d[0] is not None, d[0] or 0, tie[d[1]])):
        places = []
        for place, (_, _, words) in enumerate(unit_dedup.units(value, unit)):
            if tuple(words) in seen:
                places.append(place)
            seen.add(tuple(words))
        spans = unit_dedup.removed_spans(value, places, unit, unit_dedup.MIN_WORDS)
        assert all(0 <= s < e <= len(value) for s, e in spans)
        stays = unit_dedup.without(value, spans)
        want.add((doc_id, stays))
        assert [(x["start"], x["end"]) for x in got[(doc_id, stays)]["removed"]] == spans
    assert set(got) == want
    cut = unit_dedup.without_repeats(docs, unit)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert {(r["doc_id"], r["text"]) for r in cut.collect()} == want
    if unit == "sentence":  # the passage stays once, and short sentences stay everywhere
        assert sum(r["text"].count(sentence(902, 12)) for r in cut.filter("doc_id >= 20").collect()) == 1
        assert "Yes. No." in {r["text"] for r in cut.collect()}


def test_units_of_nothing(spark):
    assert unit_dedup.unit_spans(empty_docs(spark)).collect() == []
    assert unit_dedup.without_repeats(empty_docs(spark)).collect() == []


def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((160, 16))
    x[40:100] = x[0] + rng.standard_normal((60, 16)) * rng.uniform(0.05, 0.5, (60, 1))
    rows = [(i, x[i].tolist(), 1) for i in range(160)]
    rows += [(200, x[3].tolist(), 1), (200, x[3].tolist(), 1), (201, (x[3] * 1e30).tolist(), 2), (None, x[4].tolist(), 1)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] + [1.0] * 15, 1), (303, [None] + [1.0] * 15, 1)]
    rows += [(304, [float("inf")] + [1.0] * 15, 1), (305, [], 1), (306, [1.0, 0.0], 1), (307, [1.0, 0.0], 1)]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


@pytest.mark.parametrize("tile", [32, 4096])
def test_neighbours_against_brute_force(spark, tile):
    rows, df = vectors(spark)
    links, pairs = [0] * len(rows), []
    unit = [np.array(v) / np.abs(v).max() if usable(v) and any(v) else None for _, v, _ in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = unit[i], unit[j]
        if a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9 - 1e-12:
            links[i] += 1
            links[j] += 1
            pairs.append((i, j))
    group, first = smallest(range(len(rows)), pairs), {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            first[group[i]] = min(first.get(group[i], vec_id), vec_id)
    want = [(r[0], links[i], first.get(group[i]), r[0] is not None and r[0] == first.get(group[i])) for i, r in enumerate(rows)]
    got = tile_neighbours.neighbour_classes(df, tile=tile)
    assert rows_of(got) == sorted(want, key=repr)
    assert tile_neighbours.neighbour_classes(df.filter("vec_id < -1")).collect() == []


def test_quantisation_bound_holds():
    rng = np.random.default_rng(9)
    x = tile_neighbours.unit(rng.standard_normal((300, 48)) * rng.uniform(0.01, 9, (1, 48)))
    q, scale, lost = tile_neighbours.quantised(x)
    near = tile_neighbours.whole_products(q, q) * scale[:, None] * scale
    assert (np.abs(near - x @ x.T) <= lost[:, None] + lost + lost[:, None] * lost).all()
