"""Embedding columns: usable vectors, whole-number forms, and their blocks in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Is there a vector, with a finite number in every place?"""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda c: finite(c.cast("double"))), F.lit(False))


def scaled(vector: Column, factor: int, shift: int = 0) -> Column:
    """``floor(factor * c) + shift`` of every entry, as long."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(factor)) * c.cast("double")) + F.lit(shift).cast("long"))


def matrix(column: pa.Array, dimensions: int, kind=np.int64) -> np.ndarray:
    """A list column of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dimensions)
