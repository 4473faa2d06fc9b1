"""Components of many small clusters, linked in many parts, against brute force."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest

from bazaarspark.llm import tile_neighbours, wildcard_simhash
from tests.llm.test_duplicates import smallest


def described(rng, first: int, n: int) -> dict:
    v = pa.FixedSizeListArray.from_arrays(pa.array(rng.standard_normal(n * 3)), 3).cast(pa.list_(pa.float64()))
    return tile_neighbours.described(np.arange(first, first + n), np.ones(n, np.int64), v)


@pytest.mark.parametrize("same", [True, False])
def test_tiles_linked_in_many_parts(same, monkeypatch):
    monkeypatch.setattr(tile_neighbours, "PART", 5)
    rng = np.random.default_rng(7)
    for _ in range(200):
        one = described(rng, 0, 40)
        two = one if same else described(rng, 40, 40)
        x = one["x"] if same else np.concatenate([one["x"], two["x"]])
        near = [
            (a, b)
            for a, b in itertools.combinations(range(len(x)), 2)
            if x[a] @ x[b] >= 0.96 and (same or (a < 40) != (b < 40))
        ]
        batch = tile_neighbours.found(one, two, same, 0.96).to_pydict()
        edges = [(a, b) for a, b in zip(batch["node"], batch["other"]) if b is not None]
        assert smallest(range(len(x)), edges) == smallest(range(len(x)), near)


def cluster(rng, n: int, distance: int, chain: bool) -> list[int]:
    """Fingerprints, each `distance` bits from the one before it or from any earlier one."""
    found = [int(rng.integers(0, 2**64, dtype=np.uint64))]
    while len(found) < n:
        value = found[-1 if chain else int(rng.integers(len(found)))]
        for bit in rng.choice(64, distance, replace=False):
            value ^= 1 << int(bit)
        found.append(value)
    return found


@pytest.mark.parametrize("distance", [4, 7])
@pytest.mark.parametrize("chain", [True, False])
def test_fingerprints_linked_over_many_offsets(distance, chain):
    rng = np.random.default_rng(distance)
    for _ in range(200):
        fps = sorted(set(cluster(rng, 31, distance, chain)))
        near = [(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= distance]
        # All in one group: what the links of one key hold must span them.
        batch = wildcard_simhash.links(np.zeros(len(fps)), np.array(fps, np.uint64), distance)
        edges = list(zip(*(batch.column(c).to_numpy().view(np.uint64).tolist() for c in ("a", "b"))))
        assert smallest(fps, edges) == smallest(fps, near)
