"""Reading vector columns: which rows take part, and their entries as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column, largest: float) -> Column:
    """The vector is there, has entries, and all of them are finite numbers below ``largest`` in size.

    Whole numbers beyond the bound would not be exact in the arithmetic that follows.
    """
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= largest))
    return F.coalesce((F.size(vector) > 0) & ~odd, F.lit(False))


def of_common_length(df: DataFrame, vector: str) -> tuple[DataFrame, int, int]:
    """Rows whose vectors have the most frequent length (of several, the greatest), that length, and how many there are.

    Vectors of another length are of another space; they can neither be compared nor averaged with these.
    """
    length = F.size(vector).alias("length")
    counted = df.groupBy(length).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    size, n = (counted["length"], counted["n"]) if counted else (0, 0)
    return df.filter(F.size(vector) == size), size, n


def whole(lists: pa.Array, size: int, scale: int) -> np.ndarray:
    """floor(scale * entry) of every entry, one row for each vector; exact whole numbers in doubles."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).reshape(-1, size)
