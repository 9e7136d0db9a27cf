"""Hard negatives: for each anchor and positive, the best rows of another label that score nearly as high.

Rows are dealt into groups of bounded size, and every group meets all anchors as a stream: a query set against all rows,
in blocks. A group hands on, of each anchor, only what can still be among the first: its best rows of the same label, then
the best of other labels within each positive's window. These pair scores are packed into keys that sort by anchor,
falling score and id; one shuffle sorts them, and a pass over each partition opens a window at every positive and gives out
the negatives that follow. The pass holds the open windows of one anchor, never an anchor's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from struct import Struct

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Tables
from tierline.llm.vectors import of_common_length, usable, whole

SCALE = 256
#: Bound of an entry: products of two entries, times the scale, summed over 128 dimensions, fit 64 bits.
LARGEST = float(1 << 20)
#: Rows of a group: a table is dealt into ``GROUPS`` groups until they hold ``MOST_ROWS`` each, then into more. Larger groups
#: copy the anchors less often. It has no influence on the result.
GROUPS, LEAST_ROWS, MOST_ROWS = 64, 512, 65_536
#: Scores worked on at once.
CELLS = 1 << 21
#: Up to this size sums of whole numbers are exact in doubles.
EXACT = 2.0**52

#: Anchor, falling score, negatives after positives, id; big-endian and unsigned, so bytes sort like the values.
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("negative", "u1"), ("id", ">u8")])
_KEY = Struct(">QQBQ")
_SIGN, _TOP = 1 << 63, (1 << 63) - 1


def packed(anchor: np.ndarray, score: np.ndarray, negative: int, found: np.ndarray) -> pa.Array:
    """Keys of pairs; scores are not below zero."""
    keys = np.empty(len(anchor), KEY)
    keys["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    keys["score"] = np.uint64(_TOP) - score.astype(np.int64).view(np.uint64)
    keys["negative"] = negative
    keys["id"] = found.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    return pa.Array.from_buffers(pa.binary(KEY.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    """(anchor, score, negative, id) of a key."""
    anchor, score, negative, found = _KEY.unpack(key)
    return anchor - _SIGN, _TOP - score, negative, found - _SIGN


def _first(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``count`` greatest scores of each row that are not negative; of equal ones the leftmost."""
    if scores.shape[1] > count:
        least = np.partition(scores, -count, axis=1)[:, -count].clip(0)
    else:
        least = np.zeros(len(scores), scores.dtype)
    row, column = np.nonzero(scores >= least[:, None])
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < count], column[rank < count]


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while every sum stays exact there, else in 64-bit integers."""
    bound = np.abs(anchors).max(initial=0.0) * np.abs(rows).max(initial=0.0) * rows.shape[1]
    if 5.0 * bound < EXACT:
        return anchors @ rows.T
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


Finder = Callable[[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch], Iterator[pa.Array]]


def _positives(count: int) -> Finder:
    """The first ``count`` rows of an anchor's own label in a group."""

    def find(scores: np.ndarray, same: np.ndarray, ids: np.ndarray, anchors: pa.RecordBatch) -> Iterator[pa.Array]:
        own = anchors.column("vec_id").to_numpy()
        eligible = same & (ids[None, :] != own[:, None])
        row, column = _first(np.where(eligible, scores, -1), count)
        yield packed(own[row], scores[row, column], 0, ids[column])

    return find


def _negatives(count: int, least: tuple[int, int]) -> Finder:
    """The first ``count`` rows of other labels within each window of an anchor."""
    above, of = least

    def find(scores: np.ndarray, same: np.ndarray, ids: np.ndarray, anchors: pa.RecordBatch) -> Iterator[pa.Array]:
        own = anchors.column("vec_id").to_numpy()
        lists = anchors.column("windows")
        sizes = lists.value_lengths().to_numpy()
        flat = lists.flatten().to_numpy().astype(scores.dtype)
        starts = np.cumsum(sizes) - sizes
        cells = []
        for k in range(int(sizes.max(initial=0))):
            there = sizes > k
            top = np.full(len(own), -1, scores.dtype)
            top[there] = flat[starts[there] + k]
            inside = ~same & (scores <= top[:, None]) & (scores * of >= top[:, None] * above)
            row, column = _first(np.where(inside, scores, -1), count)
            cells.append(row * len(ids) + column)
        row, column = np.divmod(np.unique(np.concatenate(cells)), len(ids)) if cells else (np.zeros(0, np.int64),) * 2
        yield packed(own[row], scores[row, column], 1, ids[column])

    return find


def _searched(grid: DataFrame, size: int, find: Finder) -> DataFrame:
    """Keys found in every group. Per partition the rows of a group come first, then the anchors in pieces."""

    def rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), whole(batch.column("vector"), size, SCALE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, ready, last = None, [], None, None
        for batch in batches:
            place = np.stack([batch.column("part").to_numpy(), batch.column("anchor").to_numpy(zero_copy_only=False)])
            edges = [0, *(np.nonzero((place[:, 1:] != place[:, :-1]).any(axis=0))[0] + 1), batch.num_rows]
            for start, end in zip(edges, edges[1:], strict=False):
                if start == end:
                    continue
                part, is_anchor = place[:, start]
                piece = batch.slice(start, end - start)
                if part != group:
                    group, held, ready, last = part, [], None, None
                if not is_anchor:
                    held.append(rows_of(piece))
                    continue
                if not held:
                    continue
                if ready is None:
                    ids, labels, vectors = (np.concatenate(x) for x in zip(*held, strict=True))
                    _, once = np.unique(ids, return_index=True)  # of rows with one id the first counts
                    ready, held = (ids[once], labels[once], vectors[once]), [True]
                ids, labels, vectors = ready
                own = piece.column("vec_id").to_numpy()
                fresh = np.concatenate([[own[0] != last], own[1:] != own[:-1]])
                last, piece = own[-1], piece.filter(pa.array(fresh))
                step = max(1, CELLS // len(ids))
                for k in range(0, piece.num_rows, step):
                    some = piece.slice(k, step)
                    _, own_labels, own_vectors = rows_of(some)
                    scores = _scores(own_vectors, vectors)
                    for keys in find(scores, own_labels[:, None] == labels[None, :], ids, some):
                        yield pa.RecordBatch.from_arrays([keys], names=["key"])

    return grid.mapInArrow(run, "key binary")


def _grid(rows: DataFrame, anchors: DataFrame, groups: int) -> DataFrame:
    """Rows by group, and every anchor in all groups, dealt and sorted by group: rows before anchors."""
    none = F.lit(None).cast("array<long>").alias("windows")
    mine = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("part"), F.lit(False).alias("anchor"), "*", none
    )
    all_parts = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    queries = anchors.select(all_parts.alias("part"), F.lit(True).alias("anchor"), *rows.columns, "windows")
    both = mine.unionByName(queries)
    return both.repartition(groups, "part").sortWithinPartitions("part", "anchor", "vec_id", "label", "vector")


def _sorted(keys: DataFrame, partitions: int) -> RDD:
    """Keys sorted within partitions; all of an anchor in one of them, in the order of its scores."""
    pairs = keys.rdd.map(lambda r: (bytes(r[0]), None))

    def at(key: bytes) -> int:
        return int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 % (1 << 64) >> 32

    return pairs.repartitionAndSortWithinPartitions(partitions, partitionFunc=at).keys()


def _windows(count: int) -> Callable[[Iterable[bytes]], Iterator[tuple]]:
    """(anchor, ids, scores) of the first ``count`` positives of every anchor."""

    def run(keys: Iterable[bytes]) -> Iterator[tuple]:
        for anchor, found in groupby(map(unpacked, keys), key=lambda k: k[0]):
            best = [(key[3], key[1]) for _, key in zip(range(count), found, strict=False)]
            yield anchor, [i for i, _ in best], [s for _, s in best]

    return run


def _emitted(count: int, least: tuple[int, int]) -> Callable[[Iterable[bytes]], Iterator[tuple]]:
    """Walks the sorted keys: a positive opens a window, negatives go to every window that is open and still wants one."""
    above, of = least

    def run(keys: Iterable[bytes]) -> Iterator[tuple]:
        current, opened = None, []
        for anchor, score, negative, found in map(unpacked, keys):
            if anchor != current:
                current, opened = anchor, []
            # Scores only fall, so a window that is full or too high is done with.
            opened = [w for w in opened if w[2] < count and score * of >= w[1] * above]
            if not negative:
                opened.append([found, score, 0])
                continue
            for window in opened:
                window[2] += 1
                yield anchor, window[0], window[2], found, window[1], score

    return run


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    df: DataFrame,
    *,
    anchor_every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    least: tuple[int, int] = (80, 100),
) -> DataFrame:
    """For each anchor and each of its first ``positives`` positives, its first ``negatives`` hard negatives.

    ``df`` has vec_id, label and embedding; other columns are ignored, whatever their names. Anchors are the rows whose
    vec_id is divisible by ``anchor_every``. A score is the inner product of floor(256 x) over both vectors; higher scores
    come first, then smaller ids. Positives are other rows of the anchor's label; negatives are rows of another label whose
    score is no higher than the positive's and at least ``least[0] / least[1]`` of it, so positives below zero have none.

    Without part: rows with a NULL id, label or vector, empty vectors, vectors with NULL or non-finite entries or entries of
    2^20 and more in size, and vectors of another length than most have. Rows that share an id count once (the least label,
    then the least vector). Equal scores fall to the smaller id. No anchors, positives or negatives give no rows.
    """
    spark = df.sparkSession
    tables = Tables(spark)
    taken = df.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"), LARGEST))
    taken, size, n = of_common_length(
        taken.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").alias("vector")), "vector"
    )
    if not n:
        return spark.createDataFrame([], MINED)
    groups = -(-n // min(MOST_ROWS, max(LEAST_ROWS, n // GROUPS)))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchors = taken.filter(F.col("vec_id") % anchor_every == 0).withColumn("windows", F.lit(None).cast("array<long>"))

    near = _searched(_grid(taken, anchors, groups), size, _positives(positives))
    opened = _sorted(near, partitions).mapPartitions(_windows(positives))
    opened = tables.write(spark.createDataFrame(opened, "vec_id long, ids array<long>, windows array<long>"), "windows")

    # An anchor of several rows meets its windows in each of them; the search takes the first, as for the positives.
    waiting = anchors.drop("windows").join(opened.select("vec_id", "windows"), "vec_id")
    far = _searched(_grid(taken, waiting, groups), size, _negatives(negatives, least))
    near = opened.select("vec_id", F.explode(F.arrays_zip("ids", "windows")).alias("p"))
    near = near.select("vec_id", "p.ids", "p.windows").mapInArrow(_as_keys, "key binary")
    return spark.createDataFrame(_sorted(near.union(far), partitions).mapPartitions(_emitted(negatives, least)), MINED)


def _as_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchor, found, score = (batch.column(k).to_numpy() for k in range(3))
        yield pa.RecordBatch.from_arrays([packed(anchor, score, 0, found)], names=["key"])
