"""Exact dedup of arriving batches against immutable snapshots, screened by binary-fuse filters."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.llm.common import ascii_lower, stored

#: Digests per filter that the number of buckets aims at; it bounds what a task holds.
BUCKET_KEYS = 4096
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
FILTER = "bucket long, seed long, segment long, segments long, cells binary"


class FuseFilter:
    """A static 3-wise binary-fuse filter with 8-bit fingerprints over distinct 64-bit keys.

    No false negatives; about 1 in 256 strangers passes. A key's three cells lie in three neighbouring segments.
    """

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        """(three cells per key, fingerprint per key)."""
        h = keys.astype(np.uint64) + np.uint64(seed)
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(33)
        within = np.uint64(segment - 1)
        base = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
        second = (base + np.uint64(segment)) ^ ((h >> np.uint64(18)) & within)
        third = (base + np.uint64(2 * segment)) ^ (h & within)
        mark = ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)
        return np.stack([base, second, third]).astype(np.int64), mark

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys.astype(np.uint64))
        n = max(len(keys), 2)
        segment = min(1 << 18, 1 << max(2, math.floor(math.log(n) / math.log(3.33) + 2.25)))
        room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        for seed in range(1, 1000):
            segments = max(1, math.ceil(room / segment) - 2)
            cells = cls._solve(keys, seed, segment, segments)
            if cells is not None:
                return cls(seed, segment, segments, cells)
            if seed % 20 == 0:
                room *= 1.1
        raise ValueError("no filter found")

    @classmethod
    def _solve(cls, keys: np.ndarray, seed: int, segment: int, segments: int) -> np.ndarray | None:
        """Peel: all cells that only one key uses free that key, round by round; then fill them in reverse."""
        at, mark = cls.places(keys, seed, segment, segments)
        size = (segments + 2) * segment
        index = np.arange(len(keys))
        used = np.bincount(at.ravel(), minlength=size)
        owner = np.bincount(at.ravel(), weights=np.tile(index, 3), minlength=size).astype(np.int64)
        rounds, left = [], len(keys)
        while left:
            alone = np.flatnonzero(used == 1)
            freed, where = np.unique(owner[alone], return_index=True)
            if not len(freed):
                return None
            rounds.append((freed, alone[where]))
            gone = at[:, freed].ravel()
            np.subtract.at(used, gone, 1)
            np.subtract.at(owner, gone, np.tile(freed, 3))
            left -= len(freed)
        cells = np.zeros(size, np.uint8)
        for freed, cell in reversed(rounds):
            others = cells[at[0, freed]] ^ cells[at[1, freed]] ^ cells[at[2, freed]]  # the free cell is still 0
            cells[cell] = mark[freed] ^ others
        return cells

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        at, mark = self.places(keys, self.seed, self.segment, self.segments)
        return (self.cells[at[0]] ^ self.cells[at[1]] ^ self.cells[at[2]]) == mark


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    f = FuseFilter.build(rows["key"].to_numpy(np.int64).view(np.uint64))
    return pd.DataFrame({"bucket": rows["bucket"].iloc[:1], "seed": f.seed, "segment": f.segment, "segments": f.segments, "cells": [f.cells.tobytes()]})


def _probe(incoming: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    hit = np.zeros(len(incoming), bool)
    keys = incoming["key"].to_numpy(np.int64).view(np.uint64)
    for f in filters.itertuples():
        hit |= FuseFilter(f.seed, f.segment, f.segments, np.frombuffer(f.cells, np.uint8)).may_have(keys)
    return incoming.assign(maybe=hit)[["digest", "keep_id", "size", "maybe"]]


def _keyed(classes: DataFrame, buckets: int) -> DataFrame:
    return classes.withColumn("key", F.xxhash64("digest")).withColumn("bucket", F.pmod(F.hash("digest"), F.lit(buckets)).cast("long"))


def _classes(digests: DataFrame) -> DataFrame:
    return digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("size"))


def fuse_filters(classes: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of the snapshot's distinct digests."""
    return _keyed(classes, buckets).select("bucket", "key").groupBy("bucket").applyInPandas(_build, FILTER)


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Distinct incoming digests with ``maybe``: false if the snapshot surely lacks them."""
    rows = _keyed(incoming, buckets).groupBy("bucket").cogroup(filters.groupBy("bucket"))
    return rows.applyInPandas(_probe, "digest string, keep_id long, size long, maybe boolean")


def exact_dedup(docs: DataFrame, incoming: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row; rows where ``incoming`` is true arrive
    after the snapshot of the other rows was sealed.

    Equal means the same bytes after lower-casing A-Z; null text counts as empty. Of a group the largest doc_id
    stays; a null doc_id is below all others. Rows that repeat a document, id and text alike, count in group_size and
    one of them is kept. Filters screen the distinct incoming digests: those they reject are grouped among
    themselves only, the others are merged with the snapshot's digests. Whole texts of all groups are compared
    afterwards; two texts with one digest would stop the query. Other columns of ``docs`` are not read.
    """
    text = ascii_lower(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(incoming, F.lit(False)).alias("late"))
    rows = rows.withColumn("digest", F.sha2(F.col("text"), 256))
    digests = stored(rows.select("doc_id", "late", "digest"), "digests")
    snapshot = stored(_classes(digests.filter("NOT late")), "snapshot")
    arrived = stored(_classes(digests.filter("late")), "arrived")
    buckets = max(1, -(-max(snapshot.count(), arrived.count()) // BUCKET_KEYS))
    filters = stored(fuse_filters(snapshot, buckets), "filters")
    screened = stored(screen(arrived, filters, buckets), "screened")
    merged = (
        snapshot.unionByName(screened.filter("maybe").drop("maybe"))
        .groupBy("digest")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("size"))
        .unionByName(screened.filter("NOT maybe").drop("maybe"))
    )
    merged = stored(merged, "classes")
    # Only texts that share their digest are looked at: what the filters rejected and nobody repeats is never moved.
    shared = rows.select("digest", "text").join(merged.filter("size > 1").select("digest"), "digest", "left_semi")
    checked = shared.groupBy("digest", "text").agg(F.count("*").alias("n")).groupBy("digest").agg(F.count("*").alias("texts"))
    classes = merged.join(checked, "digest", "left").select(
        F.col("digest").alias("d"),
        "keep_id",
        F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts with one SHA-256"))).otherwise(F.col("size")).alias("group_size"),
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    found = digests.select("doc_id", "digest").join(classes, F.col("digest") == F.col("d")).withColumn("stays", stays)
    return _one_of_repeats(found).select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def _one_of_repeats(found: DataFrame) -> DataFrame:
    """``kept`` for one row of those that carry the group's keep_id; only such rows are numbered."""
    from pyspark.sql import Window

    kept = found.filter("stays").withColumn("kept", F.row_number().over(Window.partitionBy("digest").orderBy("doc_id")) == 1)
    return kept.unionByName(found.filter("NOT stays").withColumn("kept", F.lit(False)))
