"""Vector columns: which rows can be used, and Arrow batches as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """``(rows, size)``: (vec_id, embedding as doubles) of the rows whose vector is not
    null and has finite entries only, and the number of entries.  Vectors of another
    length than most have (ties: the longer) can't be compared and are left out, as
    are empty ones; without any row the size is 0."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    most = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()   # one row
    size = most.d if most else 0
    return rows.where(F.size("embedding") == size), size


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column without nulls as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
