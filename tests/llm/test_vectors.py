"""Hard negatives and whitening, against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from inventrace.llm import negatives, queries, vectors, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, `row` string, x string, id long, component string, leaf int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", "x", 1, "c", 2) for r in rows], SCHEMA).repartition(3)


def grid(v):
    return [math.floor(256 * float(np.float32(c))) for c in v]


def taking_part(rows, size):
    """The rows whose vector is whole and of the given length."""
    return [r for r in rows if r[1] is not None and len(r[1]) == size and all(c is not None and math.isfinite(c) for c in r[1])]


def clustered(n, size, seed, copies=0.2):
    """Vectors around a few centres, some of them copies of others, with labels that mostly follow the centre."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-0.5, 0.5) for _ in range(size)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = rng.randrange(5)
        v = rng.choice(rows)[1] if rows and rng.random() < copies else [x + rng.gauss(0, 0.1) for x in centres[c]]
        rows.append((i, v, c if rng.random() < 0.7 else rng.randrange(3)))
    return rows


ODD = [
    (7, None, 1),
    (8, [0.1, None, 0.2], 1),
    (9, [NAN, 0.1, 0.2], 1),
    (10, [INF, 0.1, 0.2], 1),
    (11, [0.5, 0.5], 1),
    (12, [], 1),
    (0, [0.5, 0.25, -0.5], None),
    (50, [0.5, 0.25, -0.5], 1),
    (50, [0.5, 0.25, -0.5], 1),
    (50, [0.5, 0.25, -0.5], 2),
    (51, [0.5, 0.25, -0.5], 1),
    (52, [0.4, 0.3, -0.5], 2),
    (53, [0.3, 0.3, -0.4], 3),
    (None, [0.4, 0.2, -0.5], 3),
    (100, [0.0, 0.0, 0.0], 4),
    (101, [0.0, 0.0, 0.0], 4),
    (102, [0.1, 0.0, 0.0], 5),
]


def brute_negatives(rows, size, relabel=False):
    """The contract, over all pairs."""
    own = []
    for i, v, label in taking_part([r for r in rows if r[2] is not None], size):
        own.append((i, (label + 1) % 10 if relabel and i is not None and i % 7 == 0 else label, grid(v)))
    x = np.array([v for _, _, v in own], dtype=object).reshape(len(own), size)
    order = lambda s, k: (-s, own[k][0] is None, own[k][0] or 0)
    out = []
    for a, (anchor, label, v) in enumerate(own):
        if anchor is None or anchor % 50:
            continue
        score = [int(s) for s in x @ np.array(v, dtype=object)]
        same = sorted((k for k in range(len(own)) if k != a and own[k][1] == label), key=lambda k: order(score[k], k))
        for p in same[:5]:
            fit = [k for k in range(len(own)) if own[k][1] != label and 50 * score[p] <= 100 * score[k] <= 95 * score[p]]
            for n, k in enumerate(sorted(fit, key=lambda k: order(score[k], k))[:3], 1):
                out.append((anchor, own[p][0], n, own[k][0], score[p], score[k]))
    return Counter(out)


def mined(df, **tree):
    found = negatives.hard_negatives(df, F.col("vec_id") % 50 == 0, **tree)
    return Counter(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in found.collect())


@pytest.mark.parametrize(
    ("n", "size", "tree"),
    [(300, 6, {}), (600, 8, {"leaf_rows": 20, "fan": 4}), (500, 2, {"leaf_rows": 10, "fan": 3, "block_rows": 7, "sample": 40})],
)
def test_negatives_are_those_of_all_pairs(spark, n, size, tree):
    rows = clustered(n, size, n)
    assert mined(table(spark, rows), **tree) == brute_negatives(rows, size)


def test_negatives_of_odd_rows(spark):
    got = mined(table(spark, ODD), leaf_rows=2, fan=2)
    assert got == brute_negatives(ODD, 3) and got[(50, 50, 1, 52, 224 + 0, 0)] == 0
    assert any(a == p == 50 for a, p, *_ in got)
    assert not mined(table(spark, ODD).where("1 = 0"))
    assert not mined(table(spark, [(50, [1.0], 1)]))


def test_one_vector_of_a_third_of_all_rows(spark):
    rows = clustered(200, 4, 9)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(100)]
    assert mined(table(spark, rows), leaf_rows=16, fan=4) == brute_negatives(rows, 4)


def test_products_are_exact_beyond_doubles():
    big = np.array([[2**40 + 1, 3], [-(2**33) - 5, 7]], np.int64)
    want = [[int(sum(int(a) * int(b) for a, b in zip(p, q))) for q in big] for p in big]
    assert vectors.products(big, big).tolist() == want
    assert list(vectors.norms(big)) == [want[0][0], want[1][1]]


def test_ranges_rule_out_leaves_but_no_answer():
    rng = np.random.default_rng(3)
    centres = rng.integers(-200, 200, (12, 8))
    x = (centres[rng.integers(0, 12, 900)] + rng.integers(-9, 10, (900, 8))).astype(np.int64)
    tree, n = negatives.grow(x[:200], 30, 5)
    for at, rows, home, squares in negatives.paths(tree, x):
        node = tree[at]
        for j in np.unique(home):
            own = squares[home == j].astype(float)
            node.near[:, j], node.far[:, j] = np.sqrt(own.min(axis=0)), np.sqrt(own.max(axis=0))
            lengths = vectors.norms(x[rows[home == j]])
            node.least[j], node.most[j] = lengths.min(), lengths.max()
    leaf = negatives.leaf_of(tree, x)
    assert leaf.max() < n
    scores = vectors.products(x[:60], x)
    low, high = scores.max(axis=1) * 9 // 10, scores.max(axis=1)
    rows, leaves = negatives.visits(tree, x[:60], low, high)
    seen = set(zip(rows.tolist(), leaves.tolist()))
    assert all((q, leaf[k]) in seen for q in range(60) for k in np.flatnonzero((scores[q] >= low[q]) & (scores[q] <= high[q])))
    assert len(seen) < 60 * n / 2


def test_registered_negatives(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    got = Counter(tuple(r[c] for c in names) for r in queries.QUERIES["op12_hard_negatives"](spark, SF).collect())
    assert got and got == brute_negatives(rows, 64, relabel=True)


def brute_whitening(rows, size, k=4):
    x = np.array([grid(r[1]) for r in taking_part(rows, size)], np.int64).reshape(-1, size)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1), (x - sums / n) @ v / np.sqrt(e), e / np.trace(cov)


def whitened(df, k=4):
    rows = whitening.whiten(df, components=k).select("row.*", *[F.col(c).alias(f"_{c}") for c in ("component", "n", "deviation", "whitened", "explained", "identity_error")]).collect()
    return sorted(rows, key=lambda r: (r.vec_id, r._component))


@pytest.mark.parametrize("size", [2, 5, 64])
def test_whitening_is_that_of_the_whole_matrix(spark, size):
    rows = clustered(300, size, size)
    n, deviation, want, explained = brute_whitening(rows, size, min(4, size))
    got = whitened(table(spark, rows))
    k = min(4, size)
    assert [r._component for r in got] == list(range(1, k + 1)) * len(rows)
    assert {r._n for r in got} == {n} and [r._deviation for r in got[::k]] == [Decimal(int(d)) for d in deviation]
    w = np.array([r._whitened for r in got]).reshape(len(rows), k)
    signs = np.sign((w * want).sum(axis=0))
    assert np.abs(w - want * signs).max() < 1e-8
    assert np.allclose([r._explained for r in got[:k]], explained, rtol=1e-10) and got[0]._identity_error < 1e-9


def test_whitening_of_odd_rows(spark):
    got = whitened(table(spark, [r for r in ODD if r[0] is not None]))
    part = taking_part([r for r in ODD if r[0] is not None], 3)
    assert Counter(r.vec_id for r in got if r._component == 1) == Counter(r[0] for r in part)
    assert {r.row for r in got} == {"r"} and max(r._component for r in got) <= 3
    for few in ([], [(1, [0.5, 0.5], 1)], [(1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)], [(1, None, 1)], [(1, [], 1)]):
        assert whitened(table(spark, few)) == []
    line = whitened(table(spark, [(i, [i / 256, 2 * i / 256, 0.0], 1) for i in range(5)]))
    assert [r._component for r in line] == [1] * 5 and abs(line[0]._explained - 1) < 1e-12


def test_huge_entries_stay_exact(spark):
    rows = [(1, [3e12, 1.0], 1), (2, [-2e12, 0.5], 1), (3, [1e11, 0.0], 1)]
    n, deviation, *_ = brute_whitening(rows, 2, 2)
    assert [r._deviation for r in whitened(table(spark, rows)) if r._component == 1] == [Decimal(int(d)) for d in deviation]


@pytest.mark.parametrize("size", [1, 2, 3, 40])
def test_eigenvectors(size):
    rng = np.random.default_rng(size)
    shapes = [np.eye(size), np.zeros((size, size)), np.ones((size, size)), np.diag(np.arange(size) // 2.0)]
    a = rng.normal(size=(size, size))
    for m in (a @ a.T, np.kron(a @ a.T, np.eye(2)), *shapes):
        values, found = whitening.eigen(m, 4)
        k = min(4, len(m))
        scale = max(np.abs(m).max() * len(m), 1)
        assert np.abs(values - np.linalg.eigvalsh(m)[::-1][:k]).max() < 1e-13 * scale
        assert np.abs(m @ found.T - found.T * values).max() < 1e-12 * scale
        assert np.abs(found @ found.T - np.eye(k)).max() < 1e-12


def test_registered_whitening(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, deviation, want, explained = brute_whitening(sorted(rows), 64)
    got = sorted(queries.QUERIES["op13_whitening"](spark, SF).collect(), key=lambda r: (r.vec_id, r.component))
    assert [(r.n, r.deviation) for r in got[::4]] == [(n, int(d)) for d in deviation]
    w = np.array([r.whitened for r in got]).reshape(-1, 4)
    assert np.abs(w - want * np.sign((w * want).sum(axis=0))).max() < 1e-8
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-4
