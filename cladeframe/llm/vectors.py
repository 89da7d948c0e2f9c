"""Vectors of a table as numpy blocks, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id long, v array<double>) of the rows whose vector is neither null nor holds null
    or non-finite entries. Other columns go; null ids and repeated rows stay."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where(v.isNotNull() & ~bad)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a list column, all of dim entries, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def lists(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as a list column."""
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(values.ravel()))


def whole(x: np.ndarray, scale: float, most: float) -> np.ndarray:
    """floor(scale * x) as long; beyond `most` sums could leave a long, which is an error."""
    y = np.floor(scale * x)
    if y.size and np.abs(y).max() > most:
        raise ArithmeticError(f"a component of {np.abs(y).max() / scale:g} is too large for exact sums in a long")
    return y.astype(np.int64)
