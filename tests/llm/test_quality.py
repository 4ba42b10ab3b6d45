"""Quality classifier."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from inventrace.llm import quality
from tests.llm.conftest import ROWS, frame


def corpus(n=400):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["an", "th", "er", "on", "re"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 60))]
        kind = rng.randint(0, 5)
        text = " ".join(w.upper() + "!!" for w in words) if kind == 0 else " ".join([words[0]] * 40) if kind == 1 else " ".join(words)
        rows.append((i, text, int(kind > 1)))
    return rows


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, label int")


@pytest.fixture(scope="module")
def model(data):
    return quality.train(data.filter(~quality.held_out(F.col("doc_id"))))


def test_held_out_is_crc32_of_the_id(spark):
    got = {r.doc_id: r.h for r in spark.range(500).select(F.col("id").alias("doc_id"), quality.held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(500)}


def test_counts_and_ratios_cover_all_rows(data):
    gathered = quality.gather(data.select("text", "label", F.lit(False).alias("fits")), 10)
    counts, sizes = quality.presence_counts(gathered)
    want = np.zeros((2, 1 << quality.FEATURE_BITS), np.int64)
    for _, text, label in corpus():
        want[label, quality.features(text.encode())] += 1
    assert (counts == want).all() and sizes.tolist() == [sum(r[2] == k for r in corpus()) for k in (0, 1)]
    ratios = quality.log_ratios(counts, sizes)
    k = int(np.argmax(counts[0]))
    assert ratios[k] == pytest.approx(np.log((counts[1, k] + 1) / (sizes[1] + 2)) - np.log((counts[0, k] + 1) / (sizes[0] + 2)))


def test_dual_descent_reaches_the_optimum_of_the_dual():
    rng = np.random.default_rng(0)
    ratios = rng.normal(size=30)
    rows = [np.unique(rng.integers(0, 30, 6)) for _ in range(60)]
    labels = (np.array([ratios[r].sum() for r in rows]) + rng.normal(size=60) > 0).astype(int)
    w, b = quality.dual_descent(rows, labels, ratios, epochs=2000)
    cost = np.where(labels == 1, 1.0, max(1.0, (labels == 1).sum() / max((labels == 0).sum(), 1)) ** 0.5) * quality.COST
    x = np.zeros((60, 31))
    for i, r in enumerate(rows):
        x[i, r], x[i, 30] = ratios[r], 1
        x[i] /= np.linalg.norm(x[i])
    sign, v = np.where(labels == 1, 1, -1), np.append(w, b)
    primal = 0.5 * v @ v + (cost * np.maximum(0, 1 - sign * (x @ v))).sum()
    for _ in range(200):
        u = v + rng.normal(size=31) * 1e-3
        assert 0.5 * u @ u + (cost * np.maximum(0, 1 - sign * (x @ u))).sum() >= primal - 1e-6


def test_held_out_accuracy(data, model):
    got = quality.score(data, model).select("row.*", "score", quality.held_out(F.col("row.doc_id")).alias("h")).filter("h").collect()
    assert len(got) > 40
    assert np.mean([(r.score >= quality.PASS_SCORE) == r.label for r in got]) > 0.95


def test_same_model_whatever_the_partitioning(data, model):
    other = quality.train(data.filter(~quality.held_out(F.col("doc_id"))).repartition(5))
    assert np.allclose(model.weights, other.weights) and model.offset == pytest.approx(other.offset)


def test_labels_held_out_are_never_read(spark, data):
    flipped = data.select("doc_id", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("label")).otherwise(F.col("label")).alias("quality"))
    plain = data.select("doc_id", F.col("label").alias("quality"))
    a, b = (sorted(quality.labelled(data.drop("label"), x).collect()) for x in (flipped, plain))
    assert a == b and a


def test_quality_takes_odd_and_no_rows(spark, odd, empty, model):
    got = quality.classify(odd, model)
    assert got.select("row.*").columns == odd.columns
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r["row"].text}) == 1
    assert quality.classify(empty, model).count() == 0
    none = quality.train(empty.select("doc_id", "text", F.lit(1).alias("label")))
    assert {r.score for r in quality.score(odd, none).collect()} == {0.5}
    one = quality.train(frame(spark, [(1, "abc", 1), (2, None, 1), (3, "x", None)], "doc_id long, text string, label int"))
    assert all(r.score == pytest.approx(0.75) for r in quality.score(odd, one).collect())


def test_fit_keeps_no_second_copy_of_its_rows():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(1 << 16, 3000, replace=False)).astype(np.int32) for _ in range(400)]
    ratios = rng.normal(size=1 << 16)
    tracemalloc.start()
    quality.dual_descent(rows, np.arange(400) % 2, ratios, epochs=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(x.nbytes for x in rows)
