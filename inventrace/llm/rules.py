"""Quality rules on texts, with verdicts on whole hosts from the failures of their documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inventrace.llm.common import flat, per_text, slices, stored, word_starts

#: Characters that rule n_symbols counts.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host fails if the shrunk share of its failing documents is above this.
HOST_LIMIT = 0.5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def repeated_words(data: np.ndarray, sep: np.ndarray, start: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, the words inside a window of five words that the text has twice or more.

    Words get exact ids from Arrow's dictionary encoding; windows are brought together by a hash of their ids
    and the text's number, and equal neighbours are then compared id by id.
    """
    first = np.flatnonzero(start)
    n = len(first)
    covered = np.zeros(n + 1, np.int64)
    words_of = per_text(start, offsets)
    if n >= WINDOW:
        letters = data[~sep]
        ends = np.concatenate([np.cumsum(~sep, dtype=np.int64)[first] - 1, [len(letters)]])
        words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(letters))])
        ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)
        text = np.repeat(np.arange(len(words_of)), words_of)
        at = np.flatnonzero(text[: n - WINDOW + 1] == text[WINDOW - 1 :])
        key = text[at].astype(np.uint64) * _MIX[WINDOW]
        for k in range(WINDOW):
            key += ids[at + k] * _MIX[k]
            key ^= key >> np.uint64(29)
            key *= _MIX[0]
        order = np.argsort(key)
        at, key = at[order], key[order]
        near = np.flatnonzero(key[1:] == key[:-1])
        a, b = at[near], at[near + 1]
        same = text[a] == text[b]
        for k in range(WINDOW):
            same &= ids[a + k] == ids[b + k]
        hit = np.unique(np.concatenate([a[same], b[same]]))
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + WINDOW, -1)
    inside = np.cumsum(covered)[:n] > 0
    bounds = np.concatenate([[0], np.cumsum(words_of)])
    return per_text(inside, bounds)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def measure(part: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The five measures of each text of the batch."""
    data, offsets = flat(part.column("text"))
    sep, start = word_starts(data, offsets)
    raw = data.tobytes()
    return {
        "n_words": per_text(start, offsets),
        "word_chars": per_text(~sep & (data & 0xC0 != 0x80), offsets),
        "n_symbols": per_text(_IS_SYMBOL[data], offsets),
        "n_dup_lines": np.array([repeated_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64),
        "n_repeat_words": repeated_words(data, sep, start, offsets),
    }


def _measure_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found = measure(part)
            failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("host"), *(pa.array(found[m]) for m in MEASURES), pa.array(failed)],
                ["doc_id", "host", *MEASURES, "base_failed"],
            )


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host, the measures and base_failed of every row. Whole texts; null text counts as empty (and fails)."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.col(text_col).cast("string").alias("text"),
    )
    columns = ", ".join(f"{m} long" for m in MEASURES)
    return rows.mapInArrow(_measure_all, f"doc_id long, host string, {columns}, base_failed boolean")


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, docs, failed, shrunk_rate, host_failed: one row per host, null included as a host of its own.

    Each host's failure rate is drawn towards the mean of all hosts by a beta prior fitted to the hosts' rates
    (method of moments): the fewer documents a host has, the less its own rate counts.
    """
    hosts = stored(
        measured.groupBy("host").agg(F.count("*").alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed")),
        "hosts",
    )
    got = hosts.agg(
        F.sum("docs").alias("docs"),
        F.sum("failed").alias("failed"),
        F.count("*").alias("hosts"),
        F.sum(F.col("failed") * F.col("failed") / F.col("docs")).alias("squares"),
    ).first()
    a, b = beta_prior(got.docs or 0, got.failed or 0, got.hosts or 0, got.squares or 0.0)
    rate = (F.col("failed") + F.lit(a)) / (F.col("docs") + F.lit(a + b))
    return hosts.select("host", "docs", "failed", rate.alias("shrunk_rate"), (rate > limit).alias("host_failed"))


def beta_prior(docs: int, failed: int, hosts: int, squares: float) -> tuple[float, float]:
    """Beta parameters from sums over hosts; ``squares`` is the sum of failed^2 / docs."""
    mean = min(max((failed + 0.5) / (docs + 1), 1e-6), 1 - 1e-6)
    if not docs:
        return mean, 1 - mean
    spread = squares / docs - (failed / docs) ** 2
    between = max(spread - mean * (1 - mean) * hosts / docs, mean * (1 - mean) * 1e-4)
    strength = max(mean * (1 - mean) / between - 1, 1.0)
    return mean * strength, (1 - mean) * strength


def host_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Measures, base_failed, host_failed and kept of every row of ``docs``.

    A row is kept if its own text passes and its host does. Repeated rows each count and each get a verdict.
    Empty input gives an empty result; columns beside the three named ones are not read.
    """
    measured = stored(base_rules(docs, id_col, text_col, host_col), "rules")
    hosts = host_verdicts(measured, limit).select(F.col("host").alias("h"), "host_failed")
    joined = measured.join(hosts, F.col("host").eqNullSafe(F.col("h")))
    return joined.select("doc_id", "host", *MEASURES, "base_failed", "host_failed", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"))
