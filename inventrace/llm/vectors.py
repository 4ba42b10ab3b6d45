"""Integer vectors of an embedding table, shared by the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole numbers up to here are exact in a double.
EXACT = 1 << 53
#: Steps of a component's grid between 0 and 1.
SCALE = 256


def whole(vector: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def on_grid(vector: Column, scale: int = SCALE) -> Column:
    """Entries as floor(scale * c), array of long; a value beyond a long becomes the nearest long."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))


def gridded(df: DataFrame, vector_col: str, name: str = "x", scale: int = SCALE) -> tuple[DataFrame, int]:
    """(rows with whole vectors, their grid vector as column ``name``; the vectors' length).

    Vectors of different lengths lie in no common space: rows of another length than the most frequent one (of equally
    frequent ones the longest) are left out. Without rows the length is 0.
    """
    vector = F.col(f"`{vector_col}`")
    rows = df.where(whole(vector))
    sizes = rows.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).head(1)
    size = sizes[0]["size"] if sizes else 0
    return rows.where(F.size(vector) == size).withColumn(name, on_grid(vector, scale)), size


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of an Arrow list column without nulls, one a row."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), size)


def lists(values: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as an Arrow list column."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def reach(*parts: np.ndarray) -> int:
    """The largest absolute value, as a Python number."""
    return max([0, *(max(int(p.max()), -int(p.min())) for p in parts if p.size)])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the integer rows of ``a`` with those of ``b``: int64, or Python numbers where doubles would round."""
    if reach(a) * reach(b) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(object) @ b.astype(object).T


def norms(a: np.ndarray) -> np.ndarray:
    """Exact squared lengths of integer rows."""
    if reach(a) ** 2 * a.shape[1] < EXACT:
        return np.einsum("ij,ij->i", a, a)
    wide = a.astype(object)
    return (wide * wide).sum(axis=1)
