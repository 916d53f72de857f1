"""Vector columns in blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def usable(table: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, v, dim`` of the rows with an id and a vector of finite numbers."""
    rows = table.select(F.col(id_column).alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter("vec_id is not null and v is not null and size(v) > 0").filter(finite).withColumn("dim", F.size("v"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def lists(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(values.ravel(), pa.float64()))
