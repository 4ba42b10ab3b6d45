"""Helpers of the training-data operators."""

from __future__ import annotations

import numpy as np
import psutil

from inventrace.llm import common


def resident() -> int:
    return psutil.Process().memory_info().rss


def test_a_task_gives_its_memory_back_when_it_ends():
    """Small arrays that were freed, with one at the end that is kept: without help the process stays as large as it was."""
    kept = []

    def run(batches):
        held = [np.ones(4000) for _ in range(10_000)]
        kept.append(np.ones(10))
        kept.append(bytes(64))
        yield from batches
        held.clear()
        kept.append(resident())

    before = resident()
    assert list(common.releasing(run)(iter([1, 2]))) == [1, 2]
    assert kept[-1] - before > 0
    assert resident() - before < 100_000_000


def test_flags_per_text():
    flags = np.array([1, 0, 1, 1, 0, 0, 1], bool)
    assert common.per_text(flags, np.array([0, 2, 2, 5, 7])).tolist() == [1, 0, 2, 1]
    assert common.per_text(flags[:0], np.array([0, 0])).tolist() == [0]
