"""Helpers shared by the training-data operators: stored tables, byte views of Arrow text, word boundaries."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inventrace import session

#: A word is a maximal run of characters other than space and the controls 09 to 0D.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a Python step holds at a time (one longer text is still taken whole).
SLICE_BYTES = 4 << 20

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back: a cut in the lineage that survives executors."""
    path = session.scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z and nothing else; null as the empty text."""
    return F.translate(F.coalesce(col, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def releasing(run: Step) -> Step:
    """A task's step that gives memory back to the system at its end.

    Worker processes stay for later tasks, also of other stages, and there are more of them than tasks run at a time; what each keeps of its
    last task's arrays would stand beside what the running ones need.
    """

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def release() -> None:
    """Give memory that numpy and Arrow have freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


#: glibc's numbers of two malloc settings: freed bytes at the heap's end that stay, and the size from which arrays are mapped alone.
_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3


def keep_freed(limit: int = 256 << 20) -> None:
    """Keep up to ``limit`` bytes of freed memory for the next arrays, where malloc would give them back and fetch them anew each time.

    For steps with many short-lived arrays of some MB; :func:`release` still gives all of it back.
    """
    set_to = getattr(ctypes.CDLL(None), "mallopt", None)  # glibc only
    if set_to is not None:
        set_to(_MMAP_THRESHOLD, 32 << 20)
        set_to(_TRIM_THRESHOLD, limit)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges with at most ``limit`` bytes of text each, but at least one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(lengths), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after the other, n + 1 offsets); null counts as empty."""
    arr = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks over the bytes: separators, and first bytes of words. Texts end words."""
    sep = SEPARATOR[data]
    start = ~sep
    start[1:] &= sep[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    start[first] = ~sep[first]
    return sep, start


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many set flags each text has."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))
