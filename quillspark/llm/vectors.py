"""What the vector searches share: which vectors take part, and matrices of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers of a matrix that Python handles at a time.
CELLS = 1 << 22


def finite(v: Column) -> Column:
    """Neither null nor holding null, NaN or an infinity."""
    inf = float("inf")
    return F.coalesce(v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf)), F.lit(False))


def valid(df: DataFrame, key: str, vec: str, zero: bool) -> DataFrame:
    """vec_id, v of the rows that take part, of whatever length; floats stay floats, other numbers become doubles.

    zero: whether vectors without any number but zero, empty ones among them, take part. Rows without a key can't be named.
    """
    kept = isinstance(df.schema[vec].dataType.elementType, T.FloatType)
    rows = df.select(F.col(key).cast("long").alias("vec_id"), (F.col(vec) if kept else F.col(vec).cast("array<double>")).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & finite(F.col("v")))
    return rows if zero else rows.where(F.exists("v", lambda x: x != 0))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of an Arrow list column as doubles; short ones are filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    if (size == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(size), d))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def unpack(column, d: int, kind: str) -> np.ndarray:
    """Matrix of an Arrow column of packed rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, d)
