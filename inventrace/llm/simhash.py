"""SimHash near-dedup: fingerprints of word shingles, linked by pigeonhole blocks, grouped by reachability."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inventrace.llm.common import flat, releasing, slices, stored

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
#: (blocks, blocks that must agree) per pass. With at most DISTANCE differing bits, all but DISTANCE blocks agree, so
#: each pass is exact by itself. What shares a key with more than CROWD others goes to the next, finer pass; in the
#: last one only 12 bits are free, so a key has 4096 fingerprints at most.
PASSES = ((5, 2), (8, 5), (16, 13))
CROWD = 512
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in b"\t\n\v\f\r" else c for c in range(256))
_EDGES = "a long, b long"


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle of a text that is lower-cased already."""
    words = text.split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)] if words else []
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if more than half of the hashes have it; a text without words has fingerprint 0."""
    hashes = np.array(shingle_hashes(text, shingle), np.uint64)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, body (a hash of the text) and fp (the fingerprint as a signed long) of every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part.column("text"))
                raw = data.tobytes().translate(_FOLD)
                found = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("body"), pa.array(found.view(np.int64))], ["doc_id", "body", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), text.alias("text"))
    return rows.mapInArrow(releasing(run), "doc_id long, body long, fp long")


def block_masks(blocks: int, agree: int) -> list[int]:
    """For each choice of blocks that agree, the mask of their bits."""
    cut = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [(1 << cut[k + 1]) - (1 << cut[k]) for k in range(blocks)]
    return [sum(parts[k] for k in chosen) for chosen in combinations(range(blocks), agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def keyed(fps: DataFrame, blocks: int, agree: int) -> DataFrame:
    """(choice, key, fp): a row for every choice of agreeing blocks."""
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(blocks, agree)])
    return fps.select("fp", F.posexplode(masks).alias("choice", "mask")).select("choice", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def tree(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect exactly what links of at most ``distance`` bits connect: len - 1 at most, not all pairs."""
    links, left = [], fps
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                hits = left[near]
                left = left[~near]
                links += [(x, y) for y in hits]
                queue += list(hits)
    return links


def links_in(rows: DataFrame, distance: int, crowd: int) -> DataFrame:
    """Links between fingerprints with the same (choice, key), and ``a`` = ``b`` for those whose key is crowded.

    Rows are brought together by a shuffle on the key and sorted inside the task, so a task holds one batch and at
    most ``crowd`` rows of an open key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
        open_crowd: tuple[int, int] | None = None
        for batch in batches:
            got = [np.concatenate([h, batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)]) for h, c in zip(held, ("choice", "key", "fp"), strict=True)]
            links, held, open_crowd = settle(got, open_crowd, False)
            if links:
                yield _edges(links)
        links, _, _ = settle(held, open_crowd, True)
        if links:
            yield _edges(links)

    def settle(got, open_crowd, last):
        choice, key, fp = got
        links: list[tuple[int, int]] = []
        if not len(fp):
            return links, got, open_crowd
        cut = np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(fp)]])
        stop = len(fp) if last else int(starts[-1])
        shared = np.flatnonzero(ends - starts > 1)
        if open_crowd == (int(choice[0]), int(key[0])) and ends[0] == 1:
            shared = np.concatenate([[0], shared])
        unsigned = fp.view(np.uint64)
        for g in shared.tolist():
            a, b = int(starts[g]), int(ends[g])
            name = (int(choice[a]), int(key[a]))
            if open_crowd == name or b - a > crowd:
                links += [(x, x) for x in unsigned[a:b]]
                open_crowd = name
                if b == len(fp):
                    stop = b
            elif b <= stop:
                links += tree(unsigned[a:b], distance)
        return links, [x[stop:] for x in got], open_crowd

    return rows.repartition("choice", "key").sortWithinPartitions("choice", "key").mapInArrow(releasing(run), _EDGES)


def _edges(found: list[tuple[np.uint64, np.uint64]]) -> pa.RecordBatch:
    both = np.array(found, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links among distinct fingerprints (column fp) with the same components as all pairs within ``distance`` bits."""
    found, todo = None, fps
    for level, (blocks, agree) in enumerate(PASSES):
        last = level == len(PASSES) - 1
        if blocks - agree < distance:
            raise ValueError(f"{blocks} blocks of which {agree} agree allow {blocks - agree} bits, not {distance}")
        out = stored(links_in(keyed(todo, blocks, agree), distance, 1 << 62 if last else CROWD), f"links{level}")
        own = out.filter("a != b").distinct()
        found = own if found is None else found.unionByName(own)
        todo = out.filter("a = b").select(F.col("a").alias("fp")).distinct()
        if last or todo.isEmpty():
            return found
        todo = stored(todo, f"crowd{level}")
    raise AssertionError


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges: root is the smallest node it reaches.

    Alternates large-star and small-star steps; each is an aggregate with partial results and a join, never a
    group in one place. Every round is stored, so a lost executor costs tasks of one round.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "stars")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "stars")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low.withColumnRenamed("a", "n"), F.col("a") == F.col("n")).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).filter("a != b").distinct(), "stars")
        mark = small.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen, now = mark, small
    return small.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        small.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, body, fp, component_id and stays of every row.

    Fingerprints with at most ``distance`` differing bits are linked; component_id is the smallest doc_id that a
    row reaches over links, itself included. Null and wordless texts have fingerprint 0 and are linked like others.
    A null doc_id is passed over by the minimum; a component without any other has a null component_id. ``stays`` is true for the
    row of a component with the smallest (doc_id, body), null ids last; rows that repeat both share it.
    Other columns of ``docs`` are not read.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body")
    texts = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.min(place).alias("first")), "distinct")
    roots = components(links(texts.select("fp"), distance))
    placed = texts.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", "first", F.coalesce("root", "fp").alias("root"))
    placed = stored(placed, "placed")
    whole = placed.groupBy("root").agg(F.min("low").alias("component_id"), F.min("first").alias("keeper")).withColumnRenamed("root", "r")
    named = placed.join(whole, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id", "keeper")
    joined = rows.join(named, F.col("fp") == F.col("f"))
    stays = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & F.col("body").eqNullSafe(F.col("keeper.body"))
    return joined.select("doc_id", "body", "fp", "component_id", stays.alias("stays"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the row that ``stays``, once if it is repeated."""
    staying = near_duplicates(docs, id_col, text_col, **options).filter("stays").select(F.col("doc_id").alias("i"), F.col("body").alias("b")).distinct()
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("body"))
    joined = rows.join(staying, F.col("id").eqNullSafe(F.col("i")) & (F.col("body") == F.col("b")))
    return joined.dropDuplicates(["id", "body"]).select("doc.*")
