"""Repeated byte strings across documents, by bucket-pointer refinement of the suffixes that q-gram buckets leave open.

Every string of SPAN bytes contains SPAN - Q + 1 q-grams; the one with the smallest hash (leftmost of equals) names its bucket, which
depends on the string alone. Neighbouring strings with the same q-gram form a *run*, held by the bytes around it. Runs meet by
bucket. A bucket with one run is final. A run whose bytes all occur in a document with a smaller id is repeated as a whole.
What is left goes through bucket-pointer refinement: suffixes are put into buckets by their first 8 bytes, and
buckets that still have several are sorted by the bucket numbers 8, then 16, then 18 bytes further on, each pass reusing the numbers of
the pass before, until they agree on SPAN bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.llm.common import flat, slices, stored

SPAN, Q = 50, 18
SIDE = (SPAN - Q) // 2
_WIDTH = SPAN - Q + 1
#: Runs that a task gathers before it sends them, and bytes of text that it looks at together.
FLUSH_RUNS, LOOK_BYTES = 1 << 19, 1 << 20
#: A bucket with more open runs than this (in a task: LOCAL_CROWD) is compared string by string, spread over all tasks.
CROWD, LOCAL_CROWD = 16_384, 2048
#: Strings of crowded runs of which a task remembers the smallest document so far.
KNOWN_STRINGS = 200_000
#: Bytes of runs that are refined together.
REFINE_BYTES = 2 << 20

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PIECE = 1 << 23  # longer texts are looked at in pieces; positions must fit into 24 bits
_NOBODY = np.uint32(0xFFFFFFFF)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = 1 << int(n).bit_length()
        _powers[:] = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, r, np.uint64)])) for r in (_R, _R_INVERSE)]
    return _powers[0], _powers[1]


def _mix(x: np.ndarray, factor: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(29))


def runs(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All runs of the texts: text, ordinal in the text, first and last start of a string, bucket, digest, sides.

    ``left`` and ``right`` are marks of the SIDE bytes before and after the q-gram, 0 where no string of the run holds them: two
    strings that are equal agree on one of the two at least.
    """
    n = len(data)
    empty = {k: np.zeros(0, t) for k, t in (("text", np.int64), ("ordinal", np.uint32), ("first", np.int64), ("last", np.int64), ("bucket", np.uint64), ("digest", np.uint64), ("left", np.uint16), ("right", np.uint16))}
    if n < SPAN:
        return empty
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    part = lambda a, b: (sums[b] - sums[a]) * inverse[a]
    grams = _mix((sums[Q:] - sums[:-Q]) * inverse[: n - Q + 1], 0xD6E8FEB86659FD93)
    low = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= _WIDTH:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < _WIDTH:
        low = np.minimum(low[: len(low) - (_WIDTH - width)], low[_WIDTH - width :])
    of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    starts = np.flatnonzero(of[: n - SPAN + 1] == of[SPAN - 1 :])
    if not len(starts):
        return empty
    at = (low[starts] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    first, last, at = starts[new], starts[np.append(new[1:], len(starts)) - 1], at[new]
    text = of[first].astype(np.int64)
    ordinal = np.arange(len(new)) - np.searchsorted(text, text, "left")
    digest = _mix(part(first, last + SPAN) + (at - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + (last - first).astype(np.uint64) * np.uint64(0x165667B19E3779F9), 0xA0761D6478BD642F)
    side = lambda a, b, there: np.where(there, 1 + (_mix(part(a, b), 0xE7037ED1A0B428DB) >> np.uint64(32)) % np.uint64(0xFFFF), 0).astype(np.uint16)
    has_left, has_right = at - first >= SIDE, last + SPAN >= at + Q + SIDE
    return {
        "text": text,
        "ordinal": ordinal.astype(np.uint32),
        "first": first - offsets[text],
        "last": last - offsets[text],
        "bucket": grams[at] >> np.uint64(16),
        "digest": digest >> np.uint64(16),
        "left": side(np.maximum(at - SIDE, 0), at, has_left),
        "right": side(np.minimum(at + Q, n), np.minimum(at + Q + SIDE, n), has_right),
    }


def _all_runs(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``runs`` for texts of any length: one long text is looked at in overlapping pieces."""
    if len(data) <= _PIECE:
        return runs(data, offsets)
    found, ordinal = [], 0
    for start in range(0, len(data), _PIECE - SPAN + 1):  # slices() gives a long text alone
        got = runs(data[start : start + _PIECE], np.array([0, min(_PIECE, len(data) - start)]))
        got["first"], got["last"] = got["first"] + start, got["last"] + start
        got["ordinal"] = got["ordinal"] + np.uint32(ordinal)
        ordinal += len(got["text"])
        found.append(got)
    return {k: np.concatenate([f[k] for f in found]) for k in found[0]}


# --- first step: runs meet by bucket --------------------------------------------------------------------------------

_SENT = "part long, doc bigint, body bigint, block binary, done binary, open binary, crowd binary"
_COLUMNS = (("bucket", 6), ("digest", 6), ("left", 2), ("right", 2), ("ordinal", 4))


def _planes(values: np.ndarray, size: int) -> bytes:
    """The lowest ``size`` bytes of each value, all first bytes first: columns of like bytes compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _pack(docs: np.ndarray, bodies: np.ndarray, table: dict[str, np.ndarray], who: np.ndarray) -> bytes:
    """Runs of documents as bytes. ``who`` is each run's place in ``docs`` and ascends."""
    used, counts = np.unique(who, return_counts=True)
    head = np.array([len(used), len(who)], "<u8").tobytes()
    return head + docs[used].astype("<i8").tobytes() + bodies[used].astype("<i8").tobytes() + counts.astype("<u4").tobytes() + b"".join(_planes(table[c], s) for c, s in _COLUMNS)


def _unpack(block: bytes) -> dict[str, np.ndarray]:
    n_docs, n = np.frombuffer(block, "<u8", 2).astype(int).tolist()
    at = 16
    docs, bodies = (np.frombuffer(block, "<i8", n_docs, at + 8 * n_docs * k) for k in (0, 1))
    at += 16 * n_docs
    counts = np.frombuffer(block, "<u4", n_docs, at)
    at += 4 * n_docs
    out = {"doc": np.repeat(docs, counts), "body": np.repeat(bodies, counts)}
    for c, size in _COLUMNS:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :size] = np.frombuffer(block, np.uint8, n * size, at).reshape(size, n).T
        out[c] = wide.view("<u8").ravel()
        at += n * size
    return out


def _answers(part: int, doc: np.ndarray, body: np.ndarray, ordinal: np.ndarray, state: np.ndarray) -> pa.RecordBatch | None:
    """Rows per document with the ordinals of its runs that are repeated (state 1), open (2), open in a crowd (3)."""
    told = np.flatnonzero(state)
    if not len(told):
        return None
    told = told[np.lexsort((body[told], doc[told]))]
    doc, body, ordinal, state = doc[told], body[told], ordinal[told].astype("<u4"), state[told]
    cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (body[1:] != body[:-1])]))
    ends = np.append(cut[1:], len(doc))
    lists = [[ordinal[a:b][state[a:b] == k].tobytes() for a, b in zip(cut.tolist(), ends.tolist(), strict=True)] for k in (1, 2, 3)]
    n = len(cut)
    kinds = [pa.array([part] * n, pa.int64()), pa.array(doc[cut], pa.int64()), pa.array(body[cut], pa.int64()), pa.array([None] * n, pa.binary()), *(pa.array(x, pa.binary()) for x in lists)]
    return pa.RecordBatch.from_arrays(kinds, ["part", "doc", "body", "block", "done", "open", "crowd"])


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Group number of each row of arrays that are sorted by the keys."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _send(parts: int):
    """Map side: runs that a smaller document of the same task has as a whole are settled here; the others are sent."""

    def flush(held: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        t = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
        order = np.lexsort((t["doc"], t["digest"], t["bucket"]))
        t = {k: v[order] for k, v in t.items()}
        same = _groups(t["bucket"], t["digest"])
        head = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
        lowest = t["doc"][head][same]
        state = (t["doc"] > lowest).astype(np.int8)
        bucket = _groups(t["bucket"])
        crowded = np.bincount(bucket[head]) > LOCAL_CROWD  # heads are the bucket's different runs
        state[(state == 0) & crowded[bucket]] = 3
        out = _answers(-1 - int(t["doc"][0] % parts), t["doc"], t["body"], t["ordinal"], state)
        if out is not None:
            yield out
        marks = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]) & crowded[bucket])
        keep = np.flatnonzero(state == 0)
        sent = {k: np.concatenate([v[keep], v[marks]]) for k, v in t.items()}
        sent["ordinal"][len(keep) :] = _NOBODY  # tells the bucket's task that the bucket is crowded
        part = (sent["bucket"] % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((sent["body"], sent["doc"], part))
        sent, part = {k: v[order] for k, v in sent.items()}, part[order]
        who = _groups(sent["doc"], sent["body"], part)
        rows = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        docs, bodies = sent["doc"][rows], sent["body"][rows]
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, int)
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(part)).tolist(), strict=False):
            block = _pack(docs, bodies, {c: sent[c][a:b] for c, _ in _COLUMNS}, who[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(part[a])], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([block], pa.binary()), *(pa.array([None], pa.binary()) for _ in range(3))],
                ["part", "doc", "body", "block", "done", "open", "crowd"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        size = 0
        for batch in batches:
            for some in slices(batch, limit=LOOK_BYTES):
                got = _all_runs(*flat(some.column("text")))
                text = got.pop("text")
                if not len(text):
                    continue
                got["doc"] = some.column("doc").to_numpy(zero_copy_only=False)[text]
                got["body"] = some.column("body").to_numpy(zero_copy_only=False)[text]
                del got["first"], got["last"]
                held.append(got)
                size += len(text)
                if size >= FLUSH_RUNS:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def settle(t: dict[str, np.ndarray]) -> np.ndarray:
    """State of every run of whole buckets: 1 repeated as a whole, 2 open, 3 open in a crowd, 0 final."""
    state = np.zeros(len(t["doc"]), np.int8)
    ordered = np.sort(t["bucket"])
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return state
    at = np.flatnonzero(shared[np.minimum(np.searchsorted(shared, t["bucket"]), len(shared) - 1)] == t["bucket"])
    order = at[np.lexsort((t["doc"][at], t["digest"][at], t["bucket"][at]))]
    bucket, digest, doc, nobody = (t[k][order] for k in ("bucket", "digest", "doc", "ordinal"))
    nobody = nobody == _NOBODY
    group, same = _groups(bucket), _groups(bucket, digest)
    lowest = np.full(same[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, same, doc)
    found = np.where(doc > lowest[same], 1, 0).astype(np.int8)
    for side in ("left", "right"):  # runs that share a side with another run of the bucket
        mark = t[side][order].astype(np.int64)
        turn = np.lexsort((same, mark, group))
        pair = _groups(group[turn], mark[turn])
        kinds = np.zeros(pair[-1] + 1, np.int64)
        fresh = np.concatenate([[True], (same[turn][1:] != same[turn][:-1]) | (pair[1:] != pair[:-1])])
        np.add.at(kinds, pair[fresh], 1)
        several = np.zeros(len(order), bool)
        several[turn] = (kinds[pair] > 1) & (mark[turn] > 0)
        found[several & (found == 0)] = 2
    crowd = np.bincount(group, weights=found == 2) > CROWD
    crowd[group[nobody]] = True
    found[crowd[group] & (found != 1)] = 3
    found[nobody] = 0
    state[order] = found
    return state


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: rows come sorted by part; answers of the map side pass through, a part's blocks are settled together."""
    part, blocks = None, []

    def done() -> Iterator[pa.RecordBatch]:
        got = [_unpack(b) for b in blocks]
        t = {k: np.concatenate([g.pop(k) for g in got]) for k in list(got[0])}
        out = _answers(part, t["doc"], t["body"], t["ordinal"], settle(t))
        if out is not None:
            yield out

    for batch in batches:
        told = batch.filter(pa.compute.is_null(batch.column("block")))
        if len(told):
            yield told
        for p, block in zip(batch.column("part").to_pylist(), batch.column("block"), strict=True):
            if not block.is_valid:
                continue
            if p != part and blocks:
                yield from done()
                blocks = []
            part = p
            blocks.append(block.as_py())
    if blocks:
        yield from done()


# --- second step: open runs are refined -----------------------------------------------------------------------------

_PACKED = "doc long, body long, size long, packed binary"
_OPENED = "kind int, key long, doc long, body long, first long, bytes binary, spans binary"


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: they are dealt out twice, and travel at less than half their size."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("body"), pa.array([len(t) for t in texts], pa.int64()), pa.array([press.compress(t) for t in texts], pa.binary())],
            ["doc", "body", "size", "packed"],
        )


def _ranges(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges with about LOOK_BYTES of text each."""
    ends, start = np.cumsum(batch.column("size").to_numpy(zero_copy_only=False)), 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + LOOK_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _marked(lists: pa.Array, row: int) -> np.ndarray:
    value = lists[row].as_py()
    return np.unique(np.concatenate([np.frombuffer(x, "<u4") for x in value])) if value else np.zeros(0, np.uint32)


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of documents with runs that are told of: the repeated spans (kind 0), the bytes of open runs (1), of the strings of
    crowded runs (2). Strings of crowded runs that the task has met in a smaller document are repeated and do not go on."""
    single: dict[bytes, int] = {}
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for some in _ranges(batch):
            data, offsets = flat(pa.array([unpack.decompress(t) for t in some.column("packed").to_pylist()], pa.large_binary()))
            got = _all_runs(data, offsets)
            bounds = np.searchsorted(got["text"], np.arange(len(some) + 1))
            docs, bodies = some.column("doc").to_pylist(), some.column("body").to_pylist()
            spans: list[list[np.ndarray]] = [[] for _ in docs]
            out: list[tuple] = []
            for r in sorted(range(len(some)), key=lambda r: docs[r]):
                a, raw = bounds[r], data[offsets[r] : offsets[r + 1]].tobytes()
                first, last = got["first"][a : bounds[r + 1]], got["last"][a : bounds[r + 1]]
                done = _marked(some.column("done"), r)
                spans[r].append(np.stack([first[done], last[done] + SPAN], axis=1))
                for o in _marked(some.column("open"), r).tolist():
                    out.append((1, int(got["bucket"][a + o]), docs[r], bodies[r], int(first[o]), raw[first[o] : last[o] + SPAN], None))
                for o in _marked(some.column("crowd"), r).tolist():
                    for s in range(int(first[o]), int(last[o]) + 1):
                        string = raw[s : s + SPAN]
                        if single.get(string, docs[r]) < docs[r]:
                            spans[r].append(np.array([[s, s + SPAN]]))
                        else:
                            if len(single) >= KNOWN_STRINGS:
                                single.clear()
                            single[string] = docs[r]
                            key = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little", signed=True)
                            out.append((2, key, docs[r], bodies[r], s, string, None))
                known = merge_spans(np.concatenate(spans[r]))
                if len(known):
                    out.append((0, 0, docs[r], bodies[r], 0, None, known.astype("<i8").tobytes()))
            if not out:
                continue
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "key", "doc", "body", "first", "bytes", "spans"])


def refine(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bucket numbers of the SPAN-byte strings at ``starts``: equal numbers, equal strings.

    Bucket-pointer refinement of all suffixes of ``data``; a suffix alone in its bucket is never sorted again.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(SPAN, np.uint8)])
    eight = np.ndarray((n,), ">u8", padded.tobytes(), 0, (1,)).astype(np.uint64)
    _, rank = np.unique(eight, return_inverse=True)
    rank = np.append(rank, np.full(SPAN, -1)).astype(np.int64)
    depth = 8
    while depth < SPAN:
        step = min(depth, SPAN - depth)
        shared = np.bincount(rank[:n])[rank[:n]] > 1
        todo = np.flatnonzero(shared)
        if depth + step == SPAN:
            asked = np.zeros(n, bool)
            asked[starts] = True
            todo = todo[asked[todo]]
        if not len(todo):
            break
        pairs = (rank[todo] << 32) | (rank[todo + step] + 1)
        _, fresh = np.unique(pairs, return_inverse=True)
        newer = rank.copy()
        newer[todo] = fresh + rank.max() + 1
        used, compact = np.unique(newer[:n], return_inverse=True)
        newer[:n] = compact
        rank = newer
        depth += step
    return rank[starts]


def _repeated(texts: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """Per text, which of its strings also stand in a text of a smaller document."""
    sizes = np.array([len(t) for t in texts])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    counts = sizes - SPAN + 1
    of = np.repeat(np.arange(len(texts)), counts)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[of]
    bucket = refine(np.frombuffer(b"".join(texts), np.uint8), starts)
    lowest = np.full(bucket.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, bucket, docs[of])
    return np.split(docs[of] > lowest[bucket], np.cumsum(counts)[:-1])


_FOUND = "doc long, body long, spans binary"


def _refine_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key, so that whole buckets are refined together, as many as REFINE_BYTES hold."""
    held: list[tuple] = []
    size, key = 0, None

    def done() -> Iterator[pa.RecordBatch]:
        out = []
        for (_, doc, body, first, _), hits in zip(held, _repeated([h[4] for h in held], np.array([h[1] for h in held])), strict=True):
            at = np.flatnonzero(hits)
            if len(at):
                cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
                ends = at[np.append(cut[1:], len(at)) - 1]
                out.append((doc, body, np.stack([first + at[cut], first + ends + SPAN], axis=1).astype("<i8").tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc", "body", "spans"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "body", "first", "bytes")), strict=True):
            if size >= REFINE_BYTES and row[0] != key:
                yield from done()
                held, size = [], 0
            key = row[0]
            held.append(row)
            size += len(row[4])
    if held:
        yield from done()


# --- result ---------------------------------------------------------------------------------------------------------

_RESULT = "doc long, body long, n_removed long, n_spans long, kept_sha256 string, removed binary"


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Sorted maximal spans of overlapping or touching ones."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    cut = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > ends[:-1]]))
    return np.stack([spans[cut, 0], ends[np.append(cut[1:], len(spans)) - 1]], axis=1)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for doc, body, packed, found in zip(*(batch.column(c).to_pylist() for c in ("doc", "body", "packed", "spans")), strict=True):
            raw = unpack.decompress(packed)
            spans = merge_spans(np.frombuffer(b"".join(found), "<i8").reshape(-1, 2))
            kept, at = hashlib.sha256(), 0
            for a, b in spans.tolist():
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            out.append((doc, body, int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest(), spans.astype("<i8").tobytes()))
        if out:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc", "body", "n_removed", "n_spans", "kept_sha256", "removed"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and removed (start and end of each removed span, i8) of every row.

    A byte is removed if it lies in SPAN bytes that also start in a document with a smaller id; overlaps count and strings are
    judged on the input. Null texts count as empty, texts shorter than SPAN lose nothing. A null id is below all others; rows
    with one id do not remove each other's bytes, and rows that repeat id and text have one result. Texts are UTF-8 bytes
    and matches stay inside a document. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lowest = F.lit(-(1 << 63)).cast("long")
    key: Column = F.coalesce(F.col(id_col).cast("long"), lowest)
    rows = docs.select(key.alias("doc"), F.xxhash64(key, text).alias("body"), text.alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = rows.mapInArrow(_send(parts), _SENT)
    told = stored(sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_meet, _SENT).select("doc", "body", "done", "open", "crowd"), "told")
    asked = told.groupBy("doc", "body").agg(*[F.collect_list(c).alias(c) for c in ("done", "open", "crowd")])
    texts = rows.mapInArrow(_pack_texts, _PACKED).withColumnsRenamed({"doc": "d", "body": "b"})
    same = (F.col("d") == F.col("doc")) & (F.col("b") == F.col("body"))
    opened = stored(texts.join(asked, same).select("doc", "body", "size", "packed", "done", "open", "crowd").mapInArrow(_open, _OPENED), "opened")
    strings = opened.filter("kind > 0").select("key", "doc", "body", "first", "bytes")
    refined = strings.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_refine_all, _FOUND)
    found = opened.filter("kind = 0").select("doc", "body", "spans").unionByName(refined)
    found = found.groupBy("doc", "body").agg(F.collect_list("spans").alias("spans"))
    cut = texts.join(found, same).select("doc", "body", "packed", "spans").mapInArrow(_cut, _RESULT)
    cut = stored(cut, "cut").dropDuplicates(["doc", "body"]).withColumnsRenamed({"doc": "d", "body": "b"})
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("doc"), F.xxhash64(key, text).alias("body"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    joined = whole.join(cut, (F.col("d") == F.col("doc")) & (F.col("b") == F.col("body")), "left")
    return joined.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "removed")
