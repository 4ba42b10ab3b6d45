"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by class log-count ratios (NB-SVM)."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inventrace.llm.common import flat, release, releasing, slices, stored

#: Features are hashed to 2^FEATURE_BITS places.
FEATURE_BITS = 18
#: Bytes per n-gram.
GRAM = 4
#: How often a word must follow itself for each of the repetition n-grams.
RUNS = (2, 3, 4, 6, 8, 12)
#: Bound of the labelled rows that the hinge-loss fit reads, and of their text. Log-count ratios use all labelled rows.
FIT_ROWS = 10_000
FIT_TEXT_BYTES = 20_000
SMOOTHING = 1.0
COST = 0.1
EPOCHS = 12
PASS_SCORE = 0.3

_PLACES = 1 << FEATURE_BITS
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def features(text: bytes) -> np.ndarray:
    """Places of the n-grams that a text has, each once: byte n-grams, and runs of one word as repetition n-grams."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    found = []
    for at in range(0, max(len(data) - GRAM + 1, 0), 1 << 20):  # long texts in parts that overlap by an n-gram less one
        part = data[at : at + (1 << 20) + GRAM - 1]
        grams = part[: len(part) - GRAM + 1].copy()
        for k in range(1, GRAM):
            grams |= part[k : len(part) - GRAM + 1 + k] << np.uint64(8 * k)
        found.append(np.unique((grams * _SPREAD) >> np.uint64(64 - FEATURE_BITS)))
    longest = longest_run(text)
    runs = np.array([k for k in RUNS if k <= longest], np.uint64)
    found.append(((runs << np.uint64(40)) * _SPREAD) >> np.uint64(64 - FEATURE_BITS))
    return np.unique(np.concatenate(found)).astype(np.int64)


def longest_run(text: bytes) -> int:
    """Length of the longest run of one word in a row."""
    words = text.split()
    best = run = 1 if words else 0
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 1
        best = max(best, run)
    return best


@dataclass
class Model:
    """score = 1 / (1 + exp(-(slope x margin + offset)))."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        margins = np.empty(len(texts))
        for k, text in enumerate(texts):
            x = self.weights[:, features(text)]
            margins[k] = (x[1].sum() + self.bias) / np.sqrt(x[0].sum() + 1.0)
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))


_BLOCKS, _ROWS, _SAMPLE = 64, -1, -2
#: Groups of tasks whose counts are added up before those of all tasks are: no group holds more than some megabytes of them.
_FAN = 512
_GATHERED = "label int, block int, fan int, data binary"


def gather(rows: DataFrame, fit_text_bytes: int) -> DataFrame:
    """One pass over (text, label, fits): (label, block, data).

    Blocks from 0 hold a task's counts of documents with each place, block -1 its number of documents, and block -2 the
    places of one document that the fit reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows_of = np.zeros((2, _PLACES), np.int32), np.zeros(2, np.int32)
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part.column("text"))
                raw, sample = data.tobytes(), []
                marks = zip(part.column("label").to_pylist(), part.column("fits").to_pylist(), offsets[:-1], offsets[1:], strict=True)
                for label, fits, a, b in marks:
                    places = features(raw[a:b])
                    counts[label, places] += 1
                    rows_of[label] += 1
                    if fits and b - a <= fit_text_bytes:
                        sample.append((label, _SAMPLE, places.astype(np.int32).tobytes()))
                if sample:
                    yield _gathered(sample)
        if rows_of.any():
            dense = [(label, k, part.tobytes()) for label in (0, 1) for k, part in enumerate(np.split(counts[label], _BLOCKS))]
            yield _gathered(dense + [(label, _ROWS, rows_of[label].tobytes()) for label in (0, 1)])

    return rows.mapInArrow(releasing(run), _GATHERED)


def _gathered(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    label, block, data = zip(*rows, strict=True)
    fan = pa.array([TaskContext.get().partitionId() % _FAN] * len(rows), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(block, pa.int32()), fan, pa.array(data, pa.binary())], ["label", "block", "fan", "data"])


def _summed(kind: type) -> Callable[[pa.Table], pa.Table]:
    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, kind).astype(np.int64) for x in table.column("data").to_pylist())
        return table.slice(0, 1).set_column(3, "data", pa.array([total.tobytes()], pa.binary()))

    return add


def presence_counts(gathered: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """((2, places) documents of each class that have a place, documents of each class), over all labelled rows."""
    counts, sizes = np.zeros((2, _PLACES), np.int64), np.zeros(2, np.int64)
    width = _PLACES // _BLOCKS
    some = gathered.filter(f"block <> {_SAMPLE}").groupBy("label", "block", "fan").applyInArrow(_summed(np.int32), _GATHERED)
    for r in some.groupBy("label", "block").applyInArrow(_summed(np.int64), _GATHERED).collect():  # 130 rows whatever the input
        values = np.frombuffer(r.data, np.int64)
        if r.block == _ROWS:
            sizes[r.label] = values[0]
        else:
            counts[r.label, r.block * width : (r.block + 1) * width] = values
    return counts, sizes


def log_ratios(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log of how much likelier a document of class 1 has each place than one of class 0, smoothed."""
    share = (counts + SMOOTHING) / (sizes[:, None] + 2 * SMOOTHING)
    return np.log(share[1]) - np.log(share[0])


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float = COST, epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """Hinge loss by dual coordinate descent over unit-length rows (ratio per place, and a constant for the bias)."""
    w, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    sign = np.where(labels == 1, 1.0, -1.0)
    length = np.array([np.sqrt((ratios[x] ** 2).sum() + 1.0) for x in rows])
    weight = np.where(labels == 1, 1.0, max(1.0, (labels == 1).sum() / max((labels == 0).sum(), 1)) ** 0.5) * cost
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            places = rows[i]
            values = ratios[places]  # looked up each time: kept for all rows they are twice as large as the rows
            gradient = sign[i] * (w[places] @ values + bias) / length[i] - 1
            step = min(max(alpha[i] - gradient, 0.0), weight[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[places] += (step * sign[i] / length[i]) * values
                bias += step * sign[i] / length[i]
    return w, bias


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (margin, label), by Newton steps on smoothed labels."""
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    theta = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x @ (p - goal))
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", fit_rows: int = FIT_ROWS, fit_text_bytes: int = FIT_TEXT_BYTES) -> Model:
    """Fit on rows (id, text, label 0 or 1); other labels and nulls are left out.

    Ratios count every labelled row. The hinge-loss fit and the calibration read at most ``fit_rows`` rows, the first by a hash
    of the id; of those, texts of up to ``fit_text_bytes`` bytes (longer ones still count in the ratios). Without rows of
    both classes the model gives the same score to all texts: the smoothed share of class 1.
    """
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(
        F.xxhash64(F.col(id_col).cast("long")).alias("turn"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(label_col).cast("int").alias("label")
    )
    last = rows.select("turn").orderBy("turn").limit(fit_rows).agg(F.max("turn")).first()[0]
    fits = F.col("turn") <= F.lit(last).cast("long") if last is not None else F.lit(False)
    gathered = stored(gather(rows.select("text", "label", fits.alias("fits")), fit_text_bytes), "labelled")
    counts, sizes = presence_counts(gathered)
    if not sizes.all():
        share = (sizes[1] + 1) / (sizes.sum() + 2)
        return Model(np.zeros((2, _PLACES), np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    ratios = log_ratios(counts, sizes)

    def fit(table: pa.Table) -> pa.Table:
        labels, encoded = table.column("label").to_pylist(), table.column("data").to_pylist()
        order = sorted(range(len(labels)), key=lambda i: (encoded[i], labels[i]))  # the same result whatever order rows arrive in
        own = np.array([labels[i] for i in order])
        x = [np.frombuffer(encoded[i], np.int32) for i in order]
        w, bias = dual_descent(x, own, ratios)
        margins = np.array([(w[p] @ ratios[p] + bias) / np.sqrt((ratios[p] ** 2).sum() + 1.0) for p in x])
        slope, offset = calibrate(margins, own)
        del x, encoded
        release()
        return pa.table({"w": pa.array([w.tobytes()], pa.binary()), "rest": pa.array([[bias, slope, offset]], pa.list_(pa.float64()))})

    sample = gathered.filter(f"block = {_SAMPLE}").orderBy("label", "data").limit(fit_rows)
    got = sample.groupBy("block").applyInArrow(fit, "w binary, rest array<double>").first()
    w = np.frombuffer(got.w)
    bias, slope, offset = got.rest
    return Model(np.stack([ratios * ratios, ratios * w]).astype(np.float32), bias, slope, offset)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) and score, from the whole text; null and empty texts get the score of no n-grams."""
    names = docs.columns if keep is None else keep
    rows = docs.select(F.col(text_col).cast("string").alias("__text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    loaded: list[Model] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not loaded:
            loaded.append(pickle.loads(packed.value))
        for batch in batches:
            for part in slices(batch, "__text"):
                data, offsets = flat(part.column("__text"))
                raw = data.tobytes()
                found = loaded[0].scores([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found)], ["row", "score"])

    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(releasing(run), f"row {row_type}, score double")


def held_out(id_col: Column) -> Column:
    """Rows that labels are never learned from: crc32 of the id as text, modulo 5, is 0. A null id is never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, text, label) of the documents with a label that may be learned from."""
    marks = labels.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("l"), F.col(label).cast("int").alias("label")).distinct()
    marks = marks.hint("merge")  # one plan at every size: labels grow with the documents, so broadcasting them would end somewhere
    return docs.filter(~held_out(F.col("doc_id"))).join(marks, F.col("doc_id") == F.col("l")).select("doc_id", "text", "label")


def classify(docs: DataFrame, model: Model, pass_score: float = PASS_SCORE) -> DataFrame:
    """row (all columns of ``docs``), score, predicted. Repeated rows stay; empty input gives an empty result."""
    return score(docs, model).withColumn("predicted", (F.col("score") >= pass_score).cast("int"))
