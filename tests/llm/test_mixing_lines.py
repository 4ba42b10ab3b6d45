"""Mixing and line dedup."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from inventrace.llm import lines, mixing
from tests.llm import brute
from tests.llm.conftest import ROWS, frame

NEVER = ["Python", "Pandas", "ArrowEval", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]


def test_targets_share_excess_by_weight(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, "d": 0, None: 500}
    sources = frame(spark, list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sources, mixing.cycled_weights(sources)).collect()}
    weights, total = dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2])), 1610
    want, capped = {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        want = {s: 3 * sizes[s] if s in capped else rest * w / sum(weights[x] for x in weights if x not in capped) for s, w in weights.items()}
        more = {s for s in sizes if want[s] > 3 * sizes[s] + 1e-9} - capped
        if not more:
            break
        capped |= more
    assert got == pytest.approx(want)


@pytest.mark.parametrize("cut_last", [True, False])
def test_taken_words_reach_the_target(spark, cut_last):
    rng = random.Random(1)
    rows = [(i, rng.choice("abcd"), rng.randint(0, 50)) for i in range(2000)]
    df = frame(spark, rows, "doc_id long, source string, size long")
    got = mixing.plan(df, size=F.col("size"), cut_last=cut_last).collect()
    assert len(got) == 2000
    for s in "abcd":
        own = [r for r in got if r.doc.source == s]
        taken = sum(c.words for r in own for c in r.copies)
        assert abs(taken - own[0].target) <= (0.5 if cut_last else 50)
        assert all(sum(c.words for c in r.copies) <= 3 * r.size for r in own)
    again = mixing.plan(df.repartition(7), size=F.col("size"), cut_last=cut_last).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_schedules_with_steps(spark):
    """Positions are where the integrated weight reaches each document's share, by adding up small slices."""
    rng = random.Random(5)
    schedules = {
        "a": [(0.0, 1.0), (0.5, 1.0), (0.5, 3.0), (1.0, 3.0)],
        "b": [(0.0, 0.0), (0.25, 0.0), (0.25, 2.0), (0.75, 0.0), (1.0, 0.0)],
        "c": [(0.0, 2.0), (0.0, 1.0), (1.0, 0.5), (1.0, 9.0)],
    }
    knots = frame(spark, [(s, [{"t": t, "weight": w} for t, w in k]) for s, k in schedules.items()], "source string, knots array<struct<t: double, weight: double>>")
    rows = [(i, rng.choice("abc"), 1) for i in range(3000)]
    got = mixing.mix(mixing.plan(frame(spark, rows, "doc_id long, source string, size long"), knots, size=F.col("size"))).collect()
    steps = 200_000

    def weight(own, t):
        for (t0, w0), (t1, w1) in zip(own, own[1:]):
            if t0 <= t < t1:
                return w0 + (w1 - w0) * (t - t0) / (t1 - t0)
        return 0.0

    for s, own in schedules.items():
        found = [r.position for r in got if r.doc.source == s]
        area, reached = 0.0, [0.0]
        for j in range(steps):
            area += weight(own, (j + 0.5) / steps) / steps
            reached.append(area)
        assert len(found) > 300 and found == sorted(found)
        for k, at in enumerate(found):
            assert reached[int(at * steps)] / area == pytest.approx(k / len(found), abs=3e-3)
        assert s != "b" or 0.25 <= found[0] and found[-1] <= 0.75


def test_positions_follow_the_schedule(spark):
    """Source a fades out, source b fades in: half of a is placed where its weight's integral reaches a half."""
    schedule = spark.sql("SELECT 'a' AS source, array(struct(0D AS t, 2D AS weight), struct(1D AS t, 0D AS weight)) AS knots UNION ALL SELECT 'b', array(struct(0D AS t, 0D AS weight), struct(0.5D AS t, 1D AS weight), struct(1D AS t, 2D AS weight))")
    df = frame(spark, [(i, "ab"[i % 2], 1) for i in range(2000)], "doc_id long, source string, size long")
    got = mixing.mix(mixing.plan(df, schedule, size=F.col("size"))).collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    a, b = ([r.position for r in got if r.doc.source == s] for s in "ab")
    for k in range(0, len(a), 97):
        assert a[k] == pytest.approx(1 - (1 - k / len(a)) ** 0.5, abs=1e-9)
        assert b[k] == pytest.approx((k / len(b)) ** 0.5, abs=1e-9)


def test_mixing_takes_odd_and_no_rows(odd, empty):
    planned = mixing.plan(odd)
    assert planned.count() == len(ROWS)
    sizes = sorted(len(brute.WORD.findall(r[1] or "")) for r in ROWS)
    assert sorted(r["size"] for r in planned.collect()) == sizes
    assert set(mixing.mix(planned).select("doc.*").columns) == set(odd.columns)
    assert mixing.mix(mixing.plan(empty)).count() == 0


def plans(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_plans(odd):
    for df in (mixing.mix(mixing.plan(odd)), lines.line_dedup(odd)):
        assert not [n for n in NEVER if n in plans(df)]


def test_lines_match_brute_force(spark):
    rng = random.Random(5)
    pool = [" ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 99)}" for _ in range(rng.choice([3, 8, 26, 30, 55]))) for _ in range(40)]
    docs = []
    for i in range(120):
        start = rng.randint(0, 35)
        own = pool[start : start + rng.randint(1, 6)] if rng.random() < 0.6 else [rng.choice(pool) for _ in range(rng.randint(0, 8))]
        docs.append((i, "\n".join(x for line in own for x in ([line, " "] if rng.random() < 0.1 else [line]))))
    docs += [(200, "\n".join(pool[:4] * 3)), (201, "\n".join(["same line"] * 9))]
    got = {r.doc_id: r.text for r in lines.line_dedup(frame(spark, docs).repartition(4)).collect()}
    assert got == {d: t for (d, _), t in zip(docs, brute.line_dedup(docs), strict=True)}


def test_first_occurrence_of_every_line_stays(spark):
    docs = [(1, "a\nb\nc"), (2, "a\nb\nc\nd"), (3, "b\nc\nd\ne")]
    got = sorted(lines.line_dedup(frame(spark, docs)).select("doc_id", "text", "line_dedup.removed_lines").collect())
    assert [tuple(r) for r in got] == [(1, "a\nb\nc", 0), (2, "d", 3), (3, "e", 3)]


def test_lines_take_odd_and_no_rows(odd, empty):
    got = lines.line_dedup(odd)
    assert got.columns == [*odd.columns, "line_dedup"]
    rows = got.collect()
    assert len(rows) == len(ROWS)
    assert sum(r.text is None for r in rows) == 2
    assert all(r.line_dedup.removed_lines == 0 or r.doc_id == 9 for r in rows)
    assert lines.line_dedup(empty).count() == 0
