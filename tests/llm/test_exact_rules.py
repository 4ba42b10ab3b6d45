"""Exact dedup and quality rules."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from inventrace.llm import exact, rules
from tests.llm import brute
from tests.llm.conftest import ROWS, frame


def text_of(r):
    return (r[1] or "").translate(brute.LOWER)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 100, 5000])
def test_fuse_filter_has_every_key_and_few_others(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    f = exact.FuseFilter.build(keys)
    assert f.may_have(keys).all()
    others = np.random.default_rng(n + 1).integers(1 << 63, (1 << 64) - 1, 20_000, dtype=np.uint64)
    assert f.may_have(others).mean() < 0.02


@pytest.mark.parametrize("late", ["true", "false", "doc_id > 3", "doc_id % 2 = 0"])
def test_groups_do_not_depend_on_when_rows_arrive(odd, late):
    got = exact.exact_dedup(odd, F.expr(late)).collect()
    assert len(got) == len(ROWS)
    groups: dict[str, list] = {}
    for r in ROWS:
        groups.setdefault(text_of(r), []).append(r[0])
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in got) == len(groups)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in ROWS)


def test_exact_dedup_of_nothing(empty):
    assert exact.exact_dedup(empty, F.lit(True)).count() == 0


def test_filters_screen_strangers(spark):
    snapshot = frame(spark, [(f"{i:064x}", i, 1) for i in range(300)], "digest string, keep_id long, size long")
    arrived = frame(spark, [(f"{i:064x}", i, 1) for i in range(200, 2200)], "digest string, keep_id long, size long")
    got = exact.screen(arrived, exact.fuse_filters(snapshot, 2), 2).collect()
    maybe = {r.keep_id for r in got if r.maybe}
    assert len(got) == 2000 and set(range(200, 300)) <= maybe and len(maybe) < 140


def test_measures_match_brute_force(odd):
    got = sorted((tuple(r[m] for m in rules.MEASURES) for r in rules.base_rules(odd).collect()))
    assert got == sorted(brute.rules(r[1]) for r in ROWS)


def test_repeated_windows_at_text_borders(spark):
    texts = ["a b c d e a b c d e", "a b c d e", "x a b c d", "e f g h i e f g h i j", "p p p p p p", "a\n\na\n b\na", "1 2 3 4 5 6 1 2 3 4 5 7"]
    got = {r.doc_id: tuple(r[m] for m in rules.MEASURES) for r in rules.base_rules(frame(spark, [(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string").coalesce(1)).collect()}
    assert got == {i: brute.rules(t) for i, t in enumerate(texts)}


def test_host_with_bad_documents_fails_as_a_whole(spark):
    good, bad = "one two three four five six seven eight nine ten eleven", "too short"
    rows = [(i, good if i % 10 == 0 else bad, "bad") for i in range(200)]
    rows += [(1000 + i, bad if i % 20 == 0 else good, f"h{i % 7}") for i in range(400)] + [(5000, bad, "once"), (5001, good, None)]
    got = {r.doc_id: r for r in rules.host_rules(frame(spark, rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[i].kept for i in range(200))
    assert all(got[1000 + i].kept for i in range(400) if i % 20)
    assert not got[5000].base_failed is False and got[5001].kept


def test_rules_take_odd_and_no_rows(odd, empty):
    assert rules.host_rules(odd).count() == len(ROWS)
    assert rules.host_rules(empty).count() == 0
