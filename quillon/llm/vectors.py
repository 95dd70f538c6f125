"""Vectors as whole numbers: what the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Components are held to this size, so that sums of products of some hundreds of them stay exact as doubles.
MOST = 1 << 22


def _sound(vector: str) -> Column:
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def whole(vectors: DataFrame, vector: str, out: str) -> DataFrame:
    """The rows whose vector is sound, with floor(256 * x) of its components as a list of integers in out.

    Null vectors and those with null or non-finite components go; components beyond 2^22 are held to that."""
    number = lambda x: F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), F.floor(x.cast("double") * SCALE).cast("double")))
    held = F.transform(vector, lambda x: number(F.least(F.lit(1e15), F.greatest(F.lit(-1e15), x.cast("double")))).cast("int"))
    return vectors.filter(_sound(vector)).withColumn(out, held)


def width(vectors: DataFrame, key: str, whole_numbers: str) -> int:
    """Components of the vector with the least id (the shortest of such); 0 if there is none. Others of that length count."""
    least = vectors.filter(F.col(key).isNotNull()).agg(F.min(F.struct(F.col(key).alias("k"), F.size(whole_numbers).alias("n"))).alias("m")).first()["m"]
    return least["n"] if least else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
