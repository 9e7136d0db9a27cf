"""Sequence packing by non-negative least squares over shallow length combinations.

Documents are tokenised and cut into whole windows and a rest. The rests' lengths, rounded up to a grid, make a
histogram. Combinations of two or three lengths that fill a window are enumerated; least squares finds how often to
use each without a negative count; the counts are rounded down and what is left is packed greedily. Documents then
find their place by their rank among the rests of equal length, so only the histogram reaches the driver.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Tables, map_rows, row_hash

#: Tokens of a sequence, the id that ends a document, and the steps that rest lengths are rounded up to.
WINDOW, END_ID, GRID = 2048, 1, 4
#: Rests ranked in one task, about; more rests of a length are dealt over as many tasks as that takes.
RANKED = 200_000


#: Words and word parts whose ids a worker remembers, at most each; beyond that it forgets all and starts again.
REMEMBERED = 300_000
# Texts of these characters alone are cut and lower-cased here as the tokenizer does it; all others it encodes itself.
_OTHER = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ÿ]|<\|(?:startoftext|endoftext)\|>")
# Fixed value: how this vocabulary parts a word, over those characters.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


def _byte_signs() -> dict[int, str]:
    """The visible sign that byte-level vocabularies write for each byte: itself if it is visible Latin-1, else one from
    256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Words(dict):
    """Word to number; the number's ids stand in ``pool`` between two ``ends``. Unknown words are encoded on demand."""

    def __init__(self, model):
        self.model, self.signs, self.parts = model, _byte_signs(), {}
        self.pool, self.ends = array("I"), array("q", [0])

    def __missing__(self, word: str) -> int:
        for part in _PARTS.findall(word):
            ids = self.parts.get(part)
            if ids is None:
                signs = part if part.isascii() else "".join(map(self.signs.__getitem__, part.encode()))
                if len(self.parts) >= REMEMBERED:
                    self.parts.clear()
                ids = self.parts[part] = [t.id for t in self.model.tokenize(signs)]
            self.pool.extend(ids)
        self.ends.append(len(self.pool))
        number = self[word] = len(self)
        return number

    def forget(self) -> None:
        self.clear()
        self.pool, self.ends = array("I"), array("q", [0])


class Encoder:
    """Texts to token ids of a vocabulary that white space separates; equal words are encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self.tokenizer.model)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known = self.words
        if len(known) >= REMEMBERED:
            known.forget()
        numbers = []
        for text in texts:
            words = () if _OTHER.search(text) else text.lower().split()
            numbers.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        pool, ends = np.array(known.pool, "<u4"), np.array(known.ends)
        out = []
        for text, own in zip(texts, numbers, strict=True):
            if not len(own) and text:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4"))
                continue
            begin, size = ends[own], ends[own + 1] - ends[own]
            stop = np.cumsum(size)
            at = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(begin - stop + size, size)
            out.append(pool[at])
        return out


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(row_hash, doc_id, start, length, doc_tokens, ids) for every piece: whole windows and a rest, none empty.

    ``ids`` are little-endian unsigned 32-bit token ids, the end id after the document's last. A NULL or empty text is the
    end id alone. ``vocabulary`` names a file among the public tokenizers that separates words at white space.
    """

    def make():
        import public_tokenizers

        encoder = Encoder(public_tokenizers.path(vocabulary))
        end = np.array([end_id], "<u4")

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            at, start, length, total, ids = [], [], [], [], []
            for r, tokens in enumerate(encoder.encode(texts)):
                tokens = np.concatenate([tokens, end])
                for i in range(0, len(tokens), window):
                    piece = tokens[i : i + window]
                    at.append(r)
                    start.append(i)
                    length.append(len(piece))
                    total.append(len(tokens))
                    ids.append(piece.tobytes())
            take = pa.array(at, pa.int32())
            arrays = [batch.column("row_hash").take(take), batch.column("doc_id").take(take)]
            arrays += [pa.array(x, pa.int64()) for x in (start, length, total)]
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.array(ids, pa.binary())], ["row_hash", "doc_id", "start", "length", "doc_tokens", "ids"]
            )

        return work

    rows = docs.select(
        row_hash(docs.columns).alias("row_hash"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    return map_rows(
        rows, make, "row_hash long, doc_id long, start long, length long, doc_tokens long, ids binary"
    )


def combinations(bins: int) -> np.ndarray:
    """All ways to fill ``bins`` grid steps with two or three parts, ascending; a missing third part is 0."""
    pairs = [(0, a, bins - a) for a in range(1, bins // 2 + 1)]
    triples = [
        (a, b, bins - a - b) for a in range(1, bins // 3 + 1) for b in range(a, (bins - a) // 2 + 1)
    ]
    return np.array(pairs + triples, np.int64).reshape(-1, 3)


def nonnegative(ways: np.ndarray, target: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """How often to use each way so that the parts used come closest to ``target`` in squares, no count negative.

    Active set: the way that helps most enters, ways that would turn negative leave. Part 0 counts nothing. The active
    columns stay independent, so at most as many ways are used as there are lengths.
    """
    def used(way: np.ndarray) -> np.ndarray:
        parts = np.bincount(way, minlength=len(target)).astype(float)
        parts[0] = 0
        return parts

    target = np.where(np.arange(len(target)) > 0, target, 0.0)
    x, barred = np.zeros(len(ways)), np.zeros(len(ways), bool)
    # Active ways, their products with each other and with the target.
    own, gram, right = np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0)
    rest = target.copy()
    least = tolerance * max(1.0, float(target.max()))
    for _ in range(3 * len(target)):
        gain = rest[ways].sum(axis=1)
        gain[own] = gain[barred] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= least:
            break
        parts = used(ways[best])
        cross = parts[ways[own]].sum(axis=1)
        gram = np.block([[gram, cross[:, None]], [cross[None, :], np.array([[parts @ parts]])]])
        right, own = np.append(right, target[ways[best]].sum()), np.append(own, best)
        while True:
            try:
                solved = np.linalg.solve(gram, right)
                sound = np.abs(gram @ solved - right).max() <= 1e-6 * max(1.0, target.max())
            except np.linalg.LinAlgError:
                sound = False
            if not sound:  # the new way is a sum of others
                barred[best] = True
                stay = own != best
            elif (solved > 0).all():
                x[:] = 0
                x[own] = solved
                break
            else:
                low = solved <= 0
                step = np.min(x[own][low] / np.maximum(x[own][low] - solved[low], 1e-30))
                x[own] += step * (solved - x[own])
                gone = low & (x[own] <= 1e-9)
                gone[np.argmin(np.where(low, x[own], np.inf))] = True
                x[own[gone]] = 0
                stay = ~gone
            gram, right, own = gram[np.ix_(stay, stay)], right[stay], own[stay]
            if not sound:
                break
        rest = target - np.bincount(ways[own].ravel(), np.repeat(x[own], ways.shape[1]), len(target))
        rest[0] = 0
    return x


@dataclass
class Plan:
    """Which sequence and offset the n-th rest of a length gets: for each length, slots in the order they fill."""

    first: np.ndarray  # rank at which the slot begins, within its length
    length: np.ndarray
    sequence: np.ndarray  # sequence of the slot's first rest; the next rests go to the next sequences
    offset: np.ndarray
    sequences: int


def plan(histogram: dict[int, int], window: int = WINDOW, grid: int = GRID) -> Plan:
    """Pack rests, counted by length (under ``window``), into sequences."""
    bins = window // grid
    by_bin: dict[int, dict[int, int]] = defaultdict(dict)
    for length, count in sorted(histogram.items()):
        by_bin[-(-length // grid)][length] = count
    counts = np.zeros(bins + 1, np.int64)
    for b, lengths in by_bin.items():
        counts[b] = sum(lengths.values())
    patterns: list[tuple[tuple[int, ...], int]] = []
    left = counts.copy()
    if left[bins]:
        patterns.append(((bins,), int(left[bins])))
        left[bins] = 0
    ways = combinations(bins)
    ways = ways[((counts[ways] > 0) | (ways == 0)).all(axis=1)]
    if len(ways):
        repeat = np.floor(nonnegative(ways, left.astype(float)) + 1e-9).astype(np.int64)
        for k in np.argsort(-repeat, kind="stable"):
            parts = [int(p) for p in ways[k] if p]
            fits = min(int(left[p]) // parts.count(p) for p in parts)
            times = min(int(repeat[k]), fits)
            if times:
                patterns.append((tuple(parts), times))
                for p in parts:
                    left[p] -= times
    patterns += _greedy(left, bins)
    return _slots(patterns, by_bin)


def _greedy(left: np.ndarray, bins: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first: each sequence takes the longest rest, then the longest that still fits, again and again.
    A pattern is repeated while its lengths last, so the work follows the number of lengths, not of rests."""
    left = left.copy()
    out = []
    while left.any():
        room, parts, want = bins, [], np.zeros_like(left)
        while True:
            fitting = np.flatnonzero((left - want)[: room + 1] > 0)
            if not fitting.size:
                break
            p = int(fitting[-1])
            parts.append(p)
            want[p] += 1
            room -= p
        used = want > 0
        times = int((left[used] // want[used]).min())
        left -= times * want
        out.append((tuple(parts), times))
    return out


def _slots(patterns: list[tuple[tuple[int, ...], int]], by_bin: dict[int, dict[int, int]]) -> Plan:
    """Hand each pattern's slots out to true lengths. A run of sequences is split where the length at hand runs out, so
    that all its members have the same lengths and every offset follows without a gap."""
    queue = {b: sorted(lengths.items()) for b, lengths in by_bin.items()}
    taken: dict[int, int] = defaultdict(int)
    first, length, sequence, offset = [], [], [], []
    at = 0
    for parts, times in patterns:
        while times:
            heads: dict[int, list[int]] = {}
            run = times
            for p in set(parts):
                need = parts.count(p)
                # Lengths for the ``need`` slots of this bin, from the current front of its queue.
                lengths = []
                k, room = len(queue[p]) - 1, 0
                room = queue[p][k][1]
                if room >= need:
                    lengths = [queue[p][k][0]] * need
                    run = min(run, room // need)
                else:
                    run = 1
                    while len(lengths) < need:
                        take = min(queue[p][k][1], need - len(lengths))
                        lengths += [queue[p][k][0]] * take
                        k -= 1
                heads[p] = lengths
            place = 0
            for p in parts:
                n = heads[p].pop()
                first.append(taken[n])
                length.append(n)
                sequence.append(at)
                offset.append(place)
                place += n
                taken[n] += run
                row = next(i for i in range(len(queue[p]) - 1, -1, -1) if queue[p][i][0] == n)
                rest = queue[p][row][1] - run
                queue[p][row : row + 1] = [(n, rest)] if rest else []
            at += run
            times -= run
    arrays = [np.array(x, np.int64) for x in (first, length, sequence, offset)]
    order = np.lexsort((arrays[0], arrays[1]))
    return Plan(*(x[order] for x in arrays), at)


def _ranked(rests: DataFrame) -> DataFrame:
    """Rank of each rest among those of its length, from 0. Large lengths are ranked in parts whose counts are added up."""
    parts = rests.groupBy("length").count().select("length", F.ceil(F.col("count") / RANKED).alias("parts"))
    dealt = rests.join(parts, "length").withColumn("part", F.pmod(F.xxhash64("row_hash", "copy"), F.col("parts")))
    sizes = dealt.groupBy("length", "part").count()
    before = sizes.selectExpr(
        "length", "part", "coalesce(sum(count) over (partition by length order by part rows between unbounded preceding and 1 preceding), 0) as before"
    )
    local = dealt.selectExpr(
        "*", "row_number() over (partition by length, part order by row_hash, copy) - 1 as local"
    )
    return local.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("local")).drop(
        "before", "local", "part", "parts"
    )


def place(cut: DataFrame, window: int = WINDOW, grid: int = GRID, tables: Tables | None = None) -> DataFrame:
    """Give every piece (length, row_hash; other columns pass) a sequence_id and an offset.

    Whole windows get sequences of their own behind those of the rests. Sequences are numbered from 0; within each,
    offsets leave no gap. No pieces give no rows.
    """
    spark = cut.sparkSession
    tables = tables or Tables(spark)
    cut = tables.write(cut.withColumn("copy", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.filter(F.col("length") < window).groupBy("length").count().collect()}
    packed = plan(histogram, window, grid)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            # Slots are sorted by (length, first): the last one that begins at or before the rank is the rest's.
            span = 1 << 40
            k = np.searchsorted(packed.length * span + packed.first, length * span + rank, side="right") - 1
            where = [pa.array(packed.sequence[k] + rank - packed.first[k]), pa.array(packed.offset[k])]
            names = [n for n in batch.schema.names if n != "rank"]
            return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *where], [*names, "sequence_id", "offset"])

        return work

    keys = ["length", "row_hash", "copy"]
    rests = _ranked(cut.filter(F.col("length") < window).select(*keys))
    placed = map_rows(rests.select(*keys, "rank"), make, "length long, row_hash long, copy long, sequence_id long, offset long")
    whole = _ranked(cut.filter(F.col("length") == window).select(*keys)).select(
        *keys, (F.col("rank") + packed.sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return cut.join(placed.union(whole).select("copy", "sequence_id", "offset"), "copy").drop("copy")


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, grid: int = GRID) -> DataFrame:
    """Pack whole documents into sequences of at most ``window`` tokens; one row per piece with its token ids.

    (row_hash, doc_id, start, length, doc_tokens, ids, sequence_id, offset). Each id lies in exactly one piece. NULL and
    empty texts are the end id alone. Repeated rows are packed each. Other columns only tell rows apart. No rows give none.
    """
    return place(pieces(docs, vocabulary, window, end_id), window, grid)
