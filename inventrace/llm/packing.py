"""Packing by minimum bin slack: token sequences of at most a window, with little padding.

Every document is cut at multiples of the window; what remains of it is shorter. Remainders of one length are alike, so packing needs only their
multiset, a histogram of at most one number per length whatever the data. It is planned on the driver: a window takes the longest remaining length
and then the remaining lengths that come closest to its capacity, found by subset sums over a bitset; the same filling is
repeated as often as the counts allow. Each piece then works out its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inventrace.llm.bytetokens import ByteTokenizer
from inventrace.llm.common import SLICE_BYTES, slices, stored

WINDOW, END = 2048, 1
#: Pieces of one length that one rank window sorts, about.
RANKED = 1 << 10


# --- the plan -------------------------------------------------------------------------------------------------------


def filling(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many pieces of each length fill ``capacity`` best: the multiset with the largest sum that fits.

    Bit s of ``reach`` says that some multiset of the lengths seen so far sums to s. A length enters in lots of 1, 2, 4, ... pieces, so that every
    number of them up to its count is a choice of lots. The sets before each lot are kept, to walk back from the best sum.
    """
    reach, full = 1, (1 << (capacity + 1)) - 1
    lots: list[tuple[int, int, int]] = []  # (length, pieces, reach before)
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length)
        lot = 1
        while left:
            lot = min(lot, left)
            left -= lot
            lots.append((length, lot, reach))
            reach |= reach << (length * lot) & full
            lot *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, lot, before in reversed(lots):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + lot
            total -= length * lot
    return chosen


@dataclass
class Plan:
    """Which sequence and offset the r-th piece of a length takes.

    Of each length, entry k serves the ranks from ``begin[k]`` on: ``per[k]`` pieces per sequence, from sequence ``first[k]`` and offset
    ``offset[k]`` there. ``sequences`` is how many there are.
    """

    begin: dict[int, list[int]] = field(default_factory=dict)
    per: dict[int, list[int]] = field(default_factory=dict)
    first: dict[int, list[int]] = field(default_factory=dict)
    offset: dict[int, list[int]] = field(default_factory=dict)
    sequences: int = 0

    def place(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces of one length with these ranks (from 0)."""
        begin, per, first, offset = (np.array(d[length], np.int64) for d in (self.begin, self.per, self.first, self.offset))
        at = np.searchsorted(begin, rank, "right") - 1
        turn = rank - begin[at]
        return first[at] + turn // per[at], offset[at] + length * (turn % per[at])


def plan(counts: dict[int, int], window: int = WINDOW) -> Plan:
    """Fillings for all pieces (``counts`` by length). Lengths above the window are an error; of length 0 there must be none.

    A filling is repeated until one of its lengths has too few pieces for another time. That at least halves what is left of the length, down to fewer than
    fit one window, so the number of fillings is bounded by the window, not by the pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    if any(not 0 < n <= window for n in left):
        raise ValueError("pieces must be as long as the window at most")
    out, used = Plan(), dict.fromkeys(left, 0)
    order = sorted(left)
    while order:
        largest = order[-1]
        rest = {n: c - (n == largest) for n, c in ((n, left[n]) for n in order[: bisect.bisect_right(order, window - largest)])}
        chosen = filling({n: c for n, c in rest.items() if c}, window - largest) if rest else {}
        chosen[largest] = chosen.get(largest, 0) + 1
        times = min(left[n] // c for n, c in chosen.items())
        offset = 0
        for n in sorted(chosen, reverse=True):
            for name, value in (("begin", used[n]), ("per", chosen[n]), ("first", out.sequences), ("offset", offset)):
                getattr(out, name).setdefault(n, []).append(value)
            offset += n * chosen[n]
            used[n] += chosen[n] * times
            left[n] -= chosen[n] * times
            if not left[n]:
                del left[n]
                order.remove(n)
        out.sequences += times
    return out


# --- pieces ---------------------------------------------------------------------------------------------------------


def tokenize(docs: DataFrame, definition: str, text_col: str = "text", window: int = WINDOW, end_id: int | None = END) -> DataFrame:
    """row (all columns of ``docs`` but the text), start, length, doc_tokens, ids: the pieces of every document.

    ``definition`` is the JSON text of a tokenizer of the tokenizers library. Each document's ids, with ``end_id`` after them, are cut at multiples of
    ``window``; ids are little-endian unsigned 32-bit integers. Null texts count as empty. Documents without any id (only without ``end_id``)
    have no piece. Nothing is shuffled; a task holds one slice of texts and a bounded memo of chunks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    rest = docs.drop(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ByteTokenizer(sent.value)
        for batch in batches:
            for part in slices(batch, "__text", SLICE_BYTES // 2):
                ids, ends = tokenizer.encode(part.column("__text"))
                sizes = np.diff(ends)
                if end_id is not None:
                    ids = np.insert(ids, ends[1:], end_id)
                    sizes = sizes + 1
                pieces = -(-sizes // window)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth * window
                length = np.minimum(window, sizes[doc] - start)
                begin = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
                packed = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(begin), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays([part.column("row").take(at), *(pa.array(c.astype(np.int64)) for c in (start, length, sizes[doc])), packed], ["row", "start", "length", "doc_tokens", "ids"])

    boxed = docs.select(F.col(f"`{text_col}`").cast("string").alias("__text"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest.columns]).alias("row"))
    inner = boxed.schema["row"].dataType.simpleString()
    found = boxed.mapInArrow(run, f"row {inner}, start long, length long, doc_tokens long, ids binary")
    return found.withColumn("row", F.col("row").dropFields("_")) if rest.columns else found.withColumn("row", F.lit(None).cast("string"))


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (column length, at most ``window``) with sequence_id and offset there; sequences are gapless from offset 0.

    ``pieces`` is a stored table: its files and row numbers are the identity by which pieces of one length are ranked, so repeated rows
    are pieces of their own and a lost task comes back with the same ranks. A length that most pieces have is ranked in many buckets;
    what is broadcast and collected has a row per length, so at most ``window`` rows. An empty table gives no rows.
    """
    spark, at = pieces.sparkSession, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    made = spark.sparkContext.broadcast(plan(histogram, window))
    dealt = spark.createDataFrame([(n, -(-c // RANKED)) for n, c in histogram.items()], "length long, _buckets long")

    def bucketed(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(dealt), "length").withColumn("_bucket", F.pmod(F.xxhash64("_at"), F.col("_buckets"))).drop("_buckets")

    named = bucketed(pieces.select("*", at.alias("_at")))
    counts = bucketed(pieces.select("length", at.alias("_at"))).groupBy("length", "_bucket").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    offsets = counts.select("length", "_bucket", before.alias("_before"))
    own = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_at")) - 1
    ranked = named.withColumn("_own", own).join(offsets, ["length", "_bucket"]).withColumn("_rank", F.col("_own") + F.col("_before"))
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(some):
                    sequence[some], offset[some] = made.value.place(int(length[some[0]]), rank[some])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.select(*[F.col(f"`{c}`") for c in names], "_rank").mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, definition: str, text_col: str = "text", window: int = WINDOW, end_id: int | None = END) -> DataFrame:
    """The pieces of all documents (see :func:`tokenize`), stored, with sequence_id and offset (see :func:`place`); ids come along."""
    return place(stored(tokenize(docs, definition, text_col, window, end_id), "pieces"), window)


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """sequence_id, tokens (array<long>, padded to ``window``), n_tokens, ends (where each piece ends): the rows that training reads.

    A sequence gathers at most ``window`` pieces.
    """
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "length"))).alias("parts"))
    words = F.aggregate("parts", F.lit("").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    joined = parts.select("sequence_id", words.alias("bytes"), F.transform("parts", lambda p: p["offset"] + p["length"]).alias("ends"))
    n = (F.length("bytes") / 4).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full((batch.num_rows, window), pad_id, np.int64)
            for row, b in zip(out, batch.column("bytes").to_pylist(), strict=True):
                row[: len(b) // 4] = np.frombuffer(b, "<u4")
            tokens = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * window), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), tokens, batch.column("n_tokens"), batch.column("ends")], ["sequence_id", "tokens", "n_tokens", "ends"])

    return joined.withColumn("n_tokens", n).mapInArrow(run, "sequence_id long, tokens array<long>, n_tokens int, ends array<long>")
