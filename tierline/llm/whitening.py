"""Whitening of embeddings: centred, turned to the principal components, each scaled to unit variance.

Passes over the rows: sums, products of centred rows, the whitening itself, and two over its few columns for the check.
Every task adds up its own rows and hands on one small matrix; only sums of the size of the embedding dimension
reach the driver, and only a matrix of that size is sent out again. Entries are whole numbers, and so are the centre and
the sums, so a repeated task or another partitioning gives the same model to the last bit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import ROWS
from tierline.llm.spectral import leading
from tierline.llm.vectors import of_common_length, usable, whole

SCALE, SHIFT = 1024, 100_000
#: Entries from here on, times the scale, are no longer exact as doubles.
LARGEST = float(1 << 40)

Reader = Callable[[pa.RecordBatch], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """A fitted model. ``sums`` and ``n`` describe the whole-number vectors; components are rows, greatest value first."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """Means rounded to whole numbers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """What the sums hold beyond n times the rounded means."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)]


def usable_rows(df: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int, int]:
    """Rows that take part, the length of their vectors, and how many there are."""
    return of_common_length(df.filter(usable(F.col(vector), LARGEST)), vector)


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _sums(df: DataFrame, read: Reader, kind: str) -> list:
    """Column sums in order; each task hands on one row for each column."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(read(part).sum(axis=0) for part in _parts(batches))
        if isinstance(total, np.ndarray):
            values = pa.array(total).cast(pa.int64() if kind == "long" else pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), values], names=["i", "total"])

    summed = df.mapInArrow(run, f"i int, total {kind}").groupBy("i").agg(F.sum("total").alias("total"))
    return [r["total"] for r in sorted(summed.collect())]


def _products(df: DataFrame, read: Reader, centre: np.ndarray) -> np.ndarray:
    """Sum of (row - centre) times itself transposed; each task hands on half a matrix."""
    size = len(centre)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for part in _parts(batches):
            rows = read(part) - centre
            total += rows.T @ rows
        if total.any():
            i, j = np.triu_indices(size)
            columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "value"])

    out = np.zeros((size, size))
    summed = df.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    for r in summed.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def fit(df: DataFrame, components: int, vector: str = "embedding") -> Whitening | None:
    """Fit on all rows of ``df`` whose vector is usable; None if there are none.

    Left out: NULL and empty vectors, vectors with NULL or non-finite entries or entries of 2^40 and more in size, and
    vectors of another length than most have. An entry c counts as floor(1024 c) + 100000. The covariance has divisor n:
    products are taken of entries less their rounded mean, whole numbers throughout, and what rounding the mean left over
    (at most a half) is taken off afterwards. Repeated rows count as often as they stand there. Components whose variance
    is nothing but rounding are not given, so a single row has none.
    """
    rows, size, n = usable_rows(df, vector)
    if not n:
        return None
    read = _reader(vector, size)
    sums = tuple(_sums(rows.select(vector), read, "long"))
    shape = Whitening(n, sums, np.zeros(0), np.zeros((0, size)), 0.0)
    over = np.array(shape.rest, dtype=np.float64) / n
    covariance = _products(rows.select(vector), read, shape.centre.astype(np.float64)) / n - np.outer(over, over)
    values, vectors = leading(covariance, components)
    return Whitening(n, sums, values, vectors, float(np.trace(covariance)))


def _reader(vector: str, size: int) -> Reader:
    return lambda batch: whole(batch.column(vector), size, SCALE) + SHIFT


def _deviation(centred: np.ndarray, n: int, rest: list[int]) -> pa.Array:
    """Sum of squares of n times the entries less the sums, exact: in 64 bits where they suffice, else in Python's integers."""
    most = float(n) * float(np.abs(centred).max(initial=0.0)) + max(map(abs, rest))
    if most * most * len(rest) < 2.0**62:
        apart = n * centred.astype(np.int64) - np.array(rest, dtype=np.int64)
        return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
    rows = [sum((n * int(c) - r) ** 2 for c, r in zip(row, rest, strict=True)) for row in centred]
    return pa.array(rows, type=pa.decimal128(38, 0))


def whiten(df: DataFrame, model: Whitening, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Every usable row as (key, deviation, whitened): squared distance from the sums, and one number for each component.

    Rows left out of :func:`fit` are left out here; other columns, whatever their names, are not carried along.
    """
    size, n, rest = len(model.sums), model.n, model.rest
    centre, over = model.centre.astype(np.float64), np.array(rest, dtype=np.float64) / n
    turned = (model.vectors / np.sqrt(model.values).reshape(-1, 1)).T
    read = _reader(vector, size)
    count = turned.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            centred = read(part) - centre
            made = (centred - over) @ turned
            offsets = np.arange(0, made.size + 1, count or 1, dtype=np.int32) if count else np.zeros(len(made) + 1, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.reshape(-1)))
            columns = [part.column(key), _deviation(centred, n, rest), lists]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "deviation", "whitened"])

    rows = df.filter(usable(F.col(vector), LARGEST) & (F.size(vector) == size)).select(key, vector)
    kind = df.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"{key} {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest entry in size of the whitened rows' covariance less the identity: what rounding has left."""
    count = len(model.values)
    if not count:
        return 0.0

    def read(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, count)

    rows = whitened.select("whitened")
    mean = np.array(_sums(rows, read, "double")) / model.n
    return float(np.abs(_products(rows, read, mean) / model.n - np.eye(count)).max())
