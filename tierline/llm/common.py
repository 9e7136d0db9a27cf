"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.scratch import scratch_path

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"


def blanks(text: str) -> int:
    """Code points of a text that belong to no word."""
    return sum(map(text.count, _BLANKS))


class Tables:
    """Tables written to the shared folder by one operator call.

    A written table cuts lineage: losing an executor costs a read, not a recomputation. ``drop`` frees a table as
    soon as everything made from it is written itself.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, str] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(table)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows that a worker handles at once; batches come with many more, and with what is made from them fill its memory.
ROWS = 2048


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with one function per task, made by ``make`` on the worker."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                yield work(batch.slice(start, ROWS))

    return df.mapInArrow(run, schema)


def row_hash(columns: Iterable[str]) -> Column:
    """64 bits over all columns of a row, NULLs marked, to recognise the row again."""
    names = list(columns)
    return F.xxhash64(*[F.col(f"`{c}`") for c in names], *[F.col(f"`{c}`").isNull() for c in names])
