"""Contiguous shards of least capacity, with DataFrame functions only.

Documents with equal texts form an atomic group; groups stand in the order of a hash of their text. The smallest
capacity is sought with which cutting greedily, each shard as full as it goes, needs no more shards than there are; the
shards are cut there. The search runs over sums of hash ranges: wherever a cut could fall inside a range, that range
is summed again in finer parts, until every cut lies between two groups. So a bounded number of sums reaches the driver,
however many groups there are, and the result is the exact optimum.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import Tables

#: Bits of the hash that the first sums tell apart, and how many more each refinement does.
FIRST_BITS, MORE_BITS = 12, 8
#: Documents numbered in one task, about.
NUMBERED = 200_000


@dataclass(frozen=True)
class Range:
    """Groups whose hash begins with ``bits`` bits equal to ``prefix``."""

    bits: int
    prefix: int
    size: int
    groups: int

    @property
    def low(self) -> int:
        return self.prefix << (64 - self.bits)

    @property
    def atomic(self) -> bool:
        return self.groups == 1 or self.bits == 64


def _cuts(ranges: list[Range], capacity: int, divisible: bool) -> list[int] | None:
    """Ranges' sums at which greedy shards end, or None where a range that can't be divided exceeds the capacity.

    With ``divisible``, ranges of more groups than one may be cut anywhere, which no true cutting betters.
    """
    out, used, total = [], 0, 0
    for r in ranges:
        left = r.size
        if divisible and not r.atomic:
            while used + left > capacity:
                part = capacity - used
                total += part
                out.append(total)
                left -= part
                used = 0
            used += left
            total += left
            continue
        if left > capacity:
            return None
        if used + left > capacity:
            out.append(total)
            used = 0
        used += left
        total += left
    return out


def _least(ranges: list[Range], shards: int, divisible: bool) -> int:
    """The smallest capacity that ``shards`` shards do with, by bisection."""
    total = sum(r.size for r in ranges)
    low, high = max(1, -(-total // shards)), max(1, total)
    while low < high:
        middle = (low + high) // 2
        cuts = _cuts(ranges, middle, divisible)
        if cuts is not None and len(cuts) < shards:
            high = middle
        else:
            low = middle + 1
    return low


def _open_ranges(ranges: list[Range], shards: int) -> list[int]:
    """Ranges of several groups inside which a greedy cut may fall, for some capacity between the two bounds.

    The k-th cut moves on as capacity grows. It is not before where the least capacity reaches if ranges stay whole, and
    not behind where the largest one reaches if they may be cut anywhere.
    """
    least, most = _least(ranges, shards, True), _least(ranges, shards, False)
    ends = list(accumulate(r.size for r in ranges))
    found, low, high = set(), 0, 0
    for _ in range(shards - 1):
        whole = bisect_right(ends, low + least)
        low = max(low, ends[whole - 1] if whole else 0)
        high = min(high + most, ends[-1])
        i = bisect_left(ends, high)
        if ranges[i].atomic and ends[i] > high:
            high = ends[i] - ranges[i].size
        i = bisect_right(ends, low)
        while i < len(ranges) and ends[i] - ranges[i].size < high:
            if not ranges[i].atomic:
                found.add(i)
            i += 1
    return sorted(found)


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits) if bits < 64 else h


def _sums(groups: DataFrame, bits: int, within: list[Range] | None) -> list[Range]:
    """Sums of the groups by the first ``bits`` bits of their hash, everywhere or inside the given ranges."""
    prefix = _prefix(F.col("h"), bits)
    if within:
        outer = within[0].bits
        wanted = [r.prefix if r.prefix < 1 << 63 else r.prefix - (1 << 64) for r in within]
        groups = groups.filter(_prefix(F.col("h"), outer).isin(wanted))
    rows = groups.groupBy(prefix.alias("p")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    return sorted((Range(bits, r["p"] % (1 << 64), r["size"], r["n"]) for r in rows), key=lambda r: r.low)


def boundaries(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """Hashes (unsigned) at which shards 1, 2, ... begin, and the capacity, for groups (h long, size)."""
    bits = FIRST_BITS
    ranges = _sums(groups, bits, None)
    while ranges:
        todo = _open_ranges(ranges, shards)
        if not todo:
            break
        level = min(ranges[i].bits for i in todo)
        chosen = [ranges[i] for i in todo if ranges[i].bits == level]
        finer = _sums(groups, min(64, level + MORE_BITS), chosen)
        ranges = sorted([r for r in ranges if r not in set(chosen)] + finer, key=lambda r: r.low)
    if not ranges:
        return [], 0
    capacity = _least(ranges, shards, False)
    starts, used = [], 0
    for r in ranges:
        if used + r.size > capacity:
            starts.append(r.low)
            used = 0
        used += r.size
    return starts, capacity


def _unsigned_at_least(h: Column, bound: int) -> Column:
    """Unsigned comparison of a signed long: flipping the sign bit keeps the order."""
    flipped = h.bitwiseXOR(F.lit(-(1 << 63)))
    return flipped >= F.lit(bound - (1 << 63))


def assigned(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row.

    size: UTF-8 bytes of the text plus one. Equal texts share a shard; NULL and empty texts are equal here. Slots number a
    shard's rows from 0 without a gap. The largest shard is as small as contiguous shards in hash order can be. Fewer
    groups than shards leave shards empty; repeated rows get slots of their own; other columns are ignored; no rows give
    no rows.
    """
    tables = Tables(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = tables.write(
        docs.select(
            F.col("doc_id").cast("long"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
        ),
        "sized",
    )
    groups = tables.write(rows.groupBy("h").agg(F.sum("size").alias("size")), "groups")
    starts, _ = boundaries(groups, shards)
    shard = sum((_unsigned_at_least(F.col("h"), s).cast("int") for s in starts), F.lit(0))
    placed = rows.withColumn("shard", shard)
    # Rows are numbered in parts of about equal size; a part's numbers begin where the parts before it end.
    total = rows.count()
    parts = max(1, -(-total // (shards * NUMBERED)) * 2)
    dealt = tables.write(placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "h"), F.lit(parts))), "dealt")
    sizes = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    local = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "h")) - 1
    return (
        dealt.withColumn("local", local)
        .join(begin, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("local")).alias("slot"))
    )
