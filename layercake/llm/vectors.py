"""What the operators on embeddings share: which vectors take part, and matrices of a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import list_parts


def finite(vector: Column) -> Column:
    """Neither NULL nor zero, and no component NULL, NaN or infinite."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def usable(frame: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """((vec_id, vec) of the vectors that take part, their dimension).

    The dimension is that of most finite vectors (the larger, if two are as
    frequent); others, and rows with a NULL id, take no part.
    """
    rows = frame.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vec")).where(
        finite(F.col("vec")) & F.col("vec_id").isNotNull()
    )
    sizes = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = sizes[0]["dim"] if sizes else 0
    return rows.where(F.size("vec") == dim), dim


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Equally long lists as a matrix of doubles."""
    values, _ = list_parts(column)
    return values.reshape(-1, dim).astype(np.float64)
