"""Hard-negative mining over a multiway hyperplane tree (GNAT) of integer vectors, by exact inner product.

Each node of the tree has some split points; a vector belongs below the nearest one. For every pair (split point i, subtree j) the node
holds the smallest and largest distance from i to the vectors of j. A query knows its own distance to each split point, so the triangle
inequality bounds its distance to all of j at once; a window of inner products is an annulus of distances, and subtrees whose
range does not meet it are left out. Leaves are compared exactly, so the result is that of a full search.

The tree's split points come from a bounded sample and are broadcast; ranges, leaves and counts are of all vectors. Leaves are cut into blocks
of bounded size, and queries stream past a block, so no task holds a whole leaf or all queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inventrace.llm.common import stored
from inventrace.llm.vectors import gridded, lists, matrix, norms, products

#: Vectors from which split points are chosen, at most (a documented bound: the sample only shapes the tree).
SAMPLE = 4096
#: Split points of one node, and vectors of one leaf, about.
FAN, LEAF_ROWS = 16, 2048
#: Rows of a block of a leaf; a leaf larger than the sample foretold has several.
BLOCK_ROWS = 4096
#: Inner products that a Python step holds at a time.
SLICE_PRODUCTS = 1 << 20
#: Distances are square roots: ranges are widened by this much before they are compared.
SLACK = 1e-9

NEVER = np.iinfo(np.int64).min


# --- the tree -------------------------------------------------------------------------------------------------------


@dataclass
class Node:
    """Split points (one a row), what lies below each (a node's number, or -1 - leaf), and the ranges of the subtrees.

    ``near[i, j]`` and ``far[i, j]`` bound the distance from split point i to vectors below j; ``least`` and ``most`` their squared lengths.
    A subtree without vectors has near above far.
    """

    points: np.ndarray
    below: list[int]
    near: np.ndarray = field(init=False)
    far: np.ndarray = field(init=False)
    least: np.ndarray = field(init=False)
    most: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        m = len(self.points)
        self.near, self.far = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        self.least, self.most = np.full(m, np.inf), np.full(m, -np.inf)

    def squares(self, x: np.ndarray) -> np.ndarray:
        """Exact squared distances from the rows of ``x`` to the split points."""
        return norms(x)[:, None] + norms(self.points)[None, :] - 2 * products(x, self.points)


Tree = list[Node]


def _spread(sample: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` distinct vectors of the sample, each the farthest from those chosen before it."""
    chosen = [0]
    away = Node(sample[:1], [0]).squares(sample)[:, 0]
    while len(chosen) < m and away.max() > 0:
        chosen.append(int(np.argmax(away)))
        away = np.minimum(away, Node(sample[chosen[-1:]], [0]).squares(sample)[:, 0])
    return sample[chosen]


def grow(sample: np.ndarray, leaves: int, fan: int = FAN) -> tuple[Tree, int]:
    """(tree over the sample with about ``leaves`` leaves, their number). Node 0 is the root."""
    tree: Tree = []
    n_leaves = 0

    def node(rows: np.ndarray, wanted: float) -> int:
        nonlocal n_leaves
        points = _spread(rows, max(1, min(fan, round(wanted))))
        mine = Node(points, [])
        at = len(tree)
        tree.append(mine)
        home = np.argmin(mine.squares(rows), axis=1)
        for j in range(len(points)):
            own = rows[home == j]
            share = wanted * len(own) / len(rows)
            if len(points) > 1 and share >= 2 and len(own) > 1:
                mine.below.append(node(own, share))
            else:
                mine.below.append(-1 - n_leaves)
                n_leaves += 1
        return at

    node(sample, max(leaves, 1))
    return tree, n_leaves


def paths(tree: Tree, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(node, rows that come through it, the split point each belongs to, its squared distances to all of them)."""
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        squares = tree[at].squares(x[rows])
        home = np.argmin(squares, axis=1)
        yield at, rows, home, squares
        for j, down in enumerate(tree[at].below):
            if down >= 0 and len(own := rows[home == j]):
                todo.append((down, own))


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each vector."""
    leaf = np.zeros(len(x), np.int32)
    for at, rows, home, _ in paths(tree, x):
        down = np.array(tree[at].below)[home]
        leaf[rows[down < 0]] = -1 - down[down < 0]
    return leaf


RANGES = "node int, i int, j int, low double, high double"


def _ranges(index: DataFrame, tree: Tree, size: int) -> DataFrame:
    """Smallest and largest squared distance for each (node, split point i, subtree j); i = -1 has the squared lengths."""
    sent = index.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        low = [np.full((len(n.points) + 1, len(n.points)), np.inf) for n in tree]
        high = [np.full((len(n.points) + 1, len(n.points)), -np.inf) for n in tree]
        for batch in batches:
            x = matrix(batch.column("x"), size)
            for at, rows, home, squares in paths(tree, x):
                every = np.concatenate([squares, norms(x[rows])[:, None]], axis=1).astype(np.float64)
                for j in np.unique(home):
                    own = every[home == j]
                    low[at][:, j] = np.minimum(low[at][:, j], own.min(axis=0))
                    high[at][:, j] = np.maximum(high[at][:, j], own.max(axis=0))
        for at, (lo, hi) in enumerate(zip(low, high, strict=True)):
            i, j = np.nonzero(lo <= hi)
            columns = [np.full(len(i), at, np.int32), np.where(i == lo.shape[1], -1, i).astype(np.int32), j.astype(np.int32), lo[i, j], hi[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "i", "j", "low", "high"])

    parts = index.select("x").mapInArrow(run, RANGES)
    return parts.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def meets(node: Node, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(queries x subtrees): whether the subtree may hold a vector whose inner product with the query is within low..high."""
    away = np.sqrt(node.squares(q).astype(np.float64))  # query to split points
    own = norms(q).astype(np.float64)[:, None]
    inner = np.zeros((len(q), len(node.points)))
    outer = np.full((len(q), len(node.points)), np.inf)
    for i in range(len(node.points)):
        d = away[:, i : i + 1]
        inner = np.maximum(inner, np.maximum(node.near[i] - d, d - node.far[i]))
        outer = np.minimum(outer, d + node.far[i])
    # Squared distance = |q|^2 + |x|^2 - 2 <q, x>: the annulus of distances that the window allows.
    allowed_in = own + node.least - 2 * high.astype(np.float64)[:, None]
    allowed_out = own + node.most - 2 * low.astype(np.float64)[:, None]
    room = SLACK * (own + np.where(np.isfinite(node.most), node.most, 0) + 1)
    return (inner**2 <= allowed_out + room) & (outer**2 >= allowed_in - room) & np.isfinite(node.most)


def visits(tree: Tree, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, leaf) pairs that range intersection does not rule out."""
    rows_out, leaves_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    todo = [(0, np.arange(len(q)))]
    while todo:
        at, rows = todo.pop()
        left = meets(tree[at], q[rows], low[rows], high[rows])
        for j, down in enumerate(tree[at].below):
            own = rows[left[:, j]]
            if not len(own):
                continue
            if down >= 0:
                todo.append((down, own))
            else:
                rows_out.append(own)
                leaves_out.append(np.full(len(own), -1 - down, np.int32))
    return np.concatenate(rows_out), np.concatenate(leaves_out)


# --- index and search -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Index:
    """A stored table of vector classes by leaf and block, the tree over it, and how many blocks each leaf has."""

    classes: DataFrame
    tree: Tree
    blocks: tuple[int, ...]
    size: int

    @property
    def spark(self) -> SparkSession:
        return self.classes.sparkSession


def classes_of(rows: DataFrame, keep: int) -> DataFrame:
    """One row per (x, label): ids, the ``keep`` smallest of its rows (null last).

    Rows of a class score alike, so an answer of at most ``keep`` rows never needs more of them. Each task cuts a class
    to that many before the shuffle, so a vector that many rows share is no hot group.
    """
    order = Window.partitionBy("x", "label").orderBy(F.col("id").asc_nulls_last())
    first = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep)
    ranked = F.array_sort(F.collect_list(F.struct("_n", "id")))
    return first.groupBy("x", "label").agg(ranked.alias("_ids")).select("x", "label", F.transform("_ids", lambda r: r["id"]).alias("ids"))


def build(rows: DataFrame, size: int, keep: int, leaf_rows: int = LEAF_ROWS, sample: int = SAMPLE, fan: int = FAN, block_rows: int = BLOCK_ROWS) -> Index | None:
    """The index over all rows (id, label, x of ``size`` longs); None without rows.

    ``sample`` vectors, those of smallest hash, shape the tree, which has at most ``sample`` leaves. Every class lies in one
    leaf. Leaves may be uneven; a leaf of more than ``block_rows`` classes is dealt to several blocks.
    """
    classes = stored(classes_of(rows, keep), "classes")
    total = classes.count()
    if not total or not size:
        return None
    picked = classes.select("x").orderBy(F.xxhash64("x"), "x").limit(sample).toArrow()
    tree, n_leaves = grow(matrix(picked.column("x").combine_chunks(), size), -(-total // leaf_rows), fan)
    for r in _ranges(classes, tree, size).collect():
        node = tree[r["node"]]
        if r["i"] < 0:
            node.least[r["j"]], node.most[r["j"]] = r["low"], r["high"]
        else:
            near, far = np.sqrt(r["low"]), np.sqrt(r["high"])
            node.near[r["i"], r["j"]], node.far[r["i"], r["j"]] = near * (1 - SLACK), far * (1 + SLACK)
    routed = _routed(classes, tree, size)
    counts = {r["leaf"]: r["count"] for r in routed.groupBy("leaf").count().collect()}
    blocks = tuple(max(1, -(-counts.get(leaf, 0) // block_rows)) for leaf in range(n_leaves))
    n_blocks = F.get(F.array(*[F.lit(b) for b in blocks]), F.col("leaf"))
    return Index(stored(routed.withColumn("block", F.pmod(F.xxhash64("x", "label"), n_blocks).cast("int")), "leaves"), tree, blocks, size)


def _routed(classes: DataFrame, tree: Tree, size: int) -> DataFrame:
    sent = classes.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = leaf_of(sent.value, matrix(batch.column("x"), size))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, f"{kinds}, leaf int")


QUERY = "qid long, part long, label long, x array<bigint>, low long, high long"


def _visited(index: Index, queries: DataFrame, seed: bool) -> DataFrame:
    """The queries once per leaf that they have to look at; ``seed``: only the leaf of the vector itself."""
    sent, size = index.spark.sparkContext.broadcast(index.tree), index.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = matrix(part.column("x"), size)
                if seed:
                    rows, leaves = np.arange(len(x)), leaf_of(sent.value, x)
                else:
                    low, high = (part.column(c).to_numpy(zero_copy_only=False) for c in ("low", "high"))
                    rows, leaves = visits(sent.value, x, low, high)
                for cut in range(0, len(rows), 8192):
                    some = part.take(pa.array(rows[cut : cut + 8192]))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(leaves[cut : cut + 8192])], [*some.schema.names, "leaf"])

    return queries.select("qid", "part", "label", "x", "low", "high").mapInArrow(run, f"{QUERY}, leaf int")


FOUND = "qid long, part long, score long, own boolean, ids array<bigint>"


def search(index: Index, queries: DataFrame, k: int, same_label: bool, seed: bool = False) -> DataFrame:
    """(qid, part, score, own, ids): classes that hold the best ``k`` rows of each query in each block it looks at.

    A query (qid, part) asks for rows of its own label, or of all others, with an inner product from low to high. ``own`` marks the class of
    the query's vector and label. Blocks and the queries that look at them meet in one partition, block first; the queries stream past it.
    """
    size = index.size
    n_blocks = F.get(F.array(*[F.lit(b) for b in index.blocks]), F.col("leaf"))
    asked = _visited(index, queries, seed).withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    none = F.lit(None)
    theirs = asked.select("leaf", "block", F.lit(1).alias("kind"), "qid", "part", "label", "x", "low", "high", none.cast("array<bigint>").alias("ids"))
    ours = index.classes.select(
        "leaf", "block", F.lit(0).alias("kind"), *[none.cast("long").alias(c) for c in ("qid", "part")], F.col("label").cast("long").alias("label"), "x", *[none.cast("long").alias(c) for c in ("low", "high")], "ids"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, block, ready = None, [], None
        for batch in batches:
            for place, kind, rows in _runs(batch):
                if place != here:
                    here, block, ready = place, [], None
                if kind == 0:
                    block.append(rows)
                elif block:
                    if ready is None:
                        ready = _Block(pa.Table.from_batches(block).combine_chunks().to_batches()[0], size)
                    yield from ready.best(rows, k, same_label)

    met = theirs.unionByName(ours).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "kind")
    return met.mapInArrow(run, FOUND)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """The batch cut where leaf, block or kind change."""
    if not batch.num_rows:
        return
    leaf, block, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "block", "kind"))
    new = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
    for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True):
        yield (int(leaf[a]), int(block[a])), int(kind[a]), batch.slice(a, b - a)


class _Block:
    """The classes of one block of a leaf, in the order that breaks ties: smallest id first, null last."""

    def __init__(self, rows: pa.RecordBatch, size: int):
        ids = rows.column("ids")
        first = ids.flatten().take(pa.array(np.asarray(ids.offsets)[:-1] - np.asarray(ids.offsets)[0])).fill_null(np.iinfo(np.int64).max)
        order = np.argsort(first.to_numpy(zero_copy_only=False), kind="stable")
        rows = rows.take(pa.array(order))
        self.x, self.size = matrix(rows.column("x"), size), size
        self.label = rows.column("label").to_numpy(zero_copy_only=False)
        self.ids = rows.column("ids")

    def best(self, queries: pa.RecordBatch, k: int, same_label: bool) -> Iterator[pa.RecordBatch]:
        n = len(self.x)
        step = max(1, SLICE_PRODUCTS // n)
        for at in range(0, queries.num_rows, step):
            part = queries.slice(at, step)
            q = matrix(part.column("x"), self.size)
            label, low, high = (part.column(c).to_numpy(zero_copy_only=False)[:, None] for c in ("label", "low", "high"))
            score = products(q, self.x)
            fits = ((self.label == label) == same_label) & (score >= low) & (score <= high)
            row, place = self._top(np.where(fits, score, NEVER), k)
            own = (self.label[place] == label[row, 0]) & (self.x[place] == q[row]).all(axis=1)
            columns = [part.column("qid").take(pa.array(row)), part.column("part").take(pa.array(row)), pa.array(score[row, place].astype(np.int64)), pa.array(own), self.ids.take(pa.array(place))]
            yield pa.RecordBatch.from_arrays(columns, ["qid", "part", "score", "own", "ids"])

    @staticmethod
    def _top(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, class) of the ``k`` best of each row that are not NEVER; of equal ones the earlier classes."""
        n = score.shape[1]
        if k >= n:
            return np.nonzero(score != NEVER)
        kth = np.partition(score, n - k, axis=1)[:, n - k, None]
        above = (score > kth) & (score != NEVER)
        level = (score == kth) & (score != NEVER)
        room = k - above.sum(axis=1, keepdims=True)
        return np.nonzero(above | level & (np.cumsum(level, axis=1) <= room))


def _rows_of(found: DataFrame, k: int) -> DataFrame:
    """(qid, part, score, own, id, n): the ``k`` best rows of each query, n from 1; higher scores first, then smaller ids."""
    rows = found.select("qid", "part", "score", "own", F.explode("ids").alias("id"))
    order = Window.partitionBy("qid", "part").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "own")
    return rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


def top(index: Index, queries: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The exact ``k`` best rows of each query, see :func:`_rows_of`. ``queries`` has the columns of QUERY and is stored.

    The leaf of the query's own vector goes first: where it holds k rows, the last of them raises the lower end of the window for all other leaves.
    """
    first = _rows_of(search(index, queries, k, same_label, seed=True), k)
    floor = first.where(F.col("n") == k).select("qid", "part", F.col("score").alias("_floor"))
    raised = queries.join(floor, ["qid", "part"], "left").withColumn("low", F.greatest("low", "_floor")).drop("_floor")
    return _rows_of(search(index, raised, k, same_label), k)


# --- the operator ---------------------------------------------------------------------------------------------------


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
    **tree: int,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` marks the rows that ask. An anchor's positives are its first other rows of the same label by inner product of the grid vectors
    (smaller id first among equals, null last); for each, the first rows of other labels whose score is from low to high times that of the
    positive (both ends included, as fractions) come back. Rows with a null label, a null vector, a null or non-finite entry, or
    another length than most take no part. Repeated rows are rows of their own: an anchor's copies are other rows, and each copy of an anchor
    asks. Rows without id may be found but, since no id marks them, are told apart by nothing. An empty table gives no rows. Further keywords are those of :func:`build`.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vector_col}`").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    rows, size = gridded(rows.where(F.col("label").isNotNull()), "vector")
    rows = stored(rows.select("id", "label", "x", "asks"), "vectors")
    spark = df.sparkSession
    index = build(rows.drop("asks"), size, max(positives + 1, negatives), **tree)
    if index is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    # Anchors with the same vector and label ask the same: one query for all of them.
    asking = rows.where("asks")
    bound = F.lit(1 << 62)
    kinds = stored(asking.groupBy("x", "label").agg(F.coalesce(F.min("id"), F.lit(0)).alias("_id")).select(F.monotonically_increasing_id().alias("qid"), "x", "label"), "queries")
    ask = kinds.withColumns({"part": F.lit(0).cast("long"), "low": -bound, "high": bound})
    near = stored(top(index, ask, positives + 1, same_label=True), "positives")

    scores = near.select("qid", "score").distinct()
    edge = lambda share, up: _share(F.col("score"), share, up)
    windows = stored(
        kinds.join(scores, "qid").select("qid", F.col("score").alias("part"), "label", "x", edge(low, True).alias("low"), edge(high, False).alias("high")).where("low <= high"), "windows"
    )
    far = top(index, windows, negatives, same_label=False)

    # Every anchor drops one row that is itself from the list of its query.
    listed = near.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("n", "score", "own", "id"))).alias("near"))
    mine = asking.join(kinds, ["x", "label"]).select("id", "qid").join(listed, "qid")
    itself = F.coalesce(F.array_min(F.transform(F.filter("near", lambda r: r["own"] & r["id"].eqNullSafe(F.col("id"))), lambda r: r["n"])), F.lit(0))
    others = F.slice(F.filter("near", lambda r: r["n"] != F.col("_self")), 1, positives)
    pairs = mine.withColumn("_self", itself).select(F.col("id").alias("anchor_id"), "qid", F.explode(others).alias("p"))
    answers = far.select("qid", F.col("part").alias("positive_score"), F.col("n").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    asked = pairs.select("anchor_id", F.col("p.id").alias("positive_id"), "qid", F.col("p.score").alias("positive_score"))
    return asked.join(answers, ["qid", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _share(score: Column, share: tuple[int, int], up: bool) -> Column:
    """The whole number next above (``up``) or below ``share`` times the score, exactly."""
    n, d = share
    wide = score.cast("decimal(30,0)") * n
    rest = F.pmod(wide, F.lit(d).cast("decimal(30,0)"))
    down = ((wide - rest) / d).cast("decimal(30,0)")
    return (down + F.when(rest > 0, 1).otherwise(0) if up else down).cast("long")
