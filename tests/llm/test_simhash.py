"""SimHash near-dedup."""

from __future__ import annotations

import numpy as np
import pytest

from inventrace.llm import simhash
from tests.llm import brute
from tests.llm.conftest import ROWS, frame


def test_fingerprints_match_brute_force(odd):
    got = sorted(r.fp & (2**64 - 1) for r in simhash.fingerprints(odd).collect())
    assert got == sorted(brute.fingerprint(r[1]) for r in ROWS)


@pytest.mark.parametrize("blocks,agree", simhash.PASSES)
def test_close_pairs_share_a_block(blocks, agree):
    masks = simhash.block_masks(blocks, agree)
    rng = np.random.default_rng(0)
    for _ in range(300):
        diff = sum(1 << int(b) for b in rng.choice(64, simhash.DISTANCE, replace=False))
        assert any(m & diff == 0 for m in masks)


def clusters(seed, n=400):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(n // 20):
        fp = int(rng.integers(0, 1 << 63))
        for _ in range(20):
            out.add(fp)
            for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                fp ^= 1 << int(b)
    out |= {fp ^ (1 << b) for fp in list(out)[:20] for b in range(0, 64, 7)}
    return sorted(out)


@pytest.mark.parametrize("crowd", [3, 512])
def test_components_are_those_of_all_pairs(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)  # small: keys overflow into the finer passes
    fps = clusters(crowd)
    want = brute.reach(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(frame(spark, [(f,) for f in signed], "fp long"), 3)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    got: dict[int, set] = {}
    for f in signed:
        got.setdefault(roots.get(f, f), set()).add(f)
    expected: dict[int, set] = {}
    for i, f in enumerate(signed):
        expected.setdefault(want[i], set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_component_of_a_long_chain(spark):
    fps = [(1 << k) - 1 for k in range(0, 60, 3)]
    docs = frame(spark, [(a, b) for a, b in zip(fps, fps[1:])], "a long, b long")
    assert {r.root for r in simhash.components(docs).collect()} == {0}


def test_one_row_of_each_component_stays(odd, empty):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == len(ROWS)
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    parts = brute.reach([brute.fingerprint(r[1]) for r in ROWS], lambda a, b: (a ^ b).bit_count() <= 3)
    assert len(ids) == len(set(parts.values()))
    assert (False, 1) in [i[:2] for i in ids] and (False, 2) not in [i[:2] for i in ids]
    assert simhash.near_duplicates(empty).count() == 0
