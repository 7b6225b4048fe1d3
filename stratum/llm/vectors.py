"""Embeddings as whole numbers: helpers of the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_vectors(
    table: DataFrame, id_col: str, vector_col: str, *, scale: int, shift: int = 0, largest: int = 2**40
) -> DataFrame:
    """``vec_id, x``: every vector without null and non-finite entries, each entry c as floor(scale * c) + shift.

    Rows whose vector is null, or holds a null, NaN or infinite entry, go; a
    null id stays.  An entry that becomes larger than ``largest`` raises an
    error: sums and squares of it could not be exact.
    """
    entries = table[vector_col].cast("array<double>")

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    def whole(c: Column) -> Column:
        scaled = F.floor(c * float(scale))
        told = F.raise_error(F.lit(f"an entry of a vector times {scale} is beyond {largest}"))
        return F.when(F.abs(c * float(scale)) <= float(largest), scaled + shift).otherwise(told.cast("long"))

    kept = table.select(table[id_col].cast("long").alias("vec_id"), entries.alias("entries"))
    # coalesce: a null vector has no verdict of its own
    kept = kept.filter(F.coalesce(F.forall("entries", finite), F.lit(False)))
    return kept.select("vec_id", F.transform("entries", whole).alias("x"))


def matrix(column: pa.Array, dtype: type = np.int64) -> np.ndarray:
    """A list column whose rows are equally long as a two-dimensional array."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1)
