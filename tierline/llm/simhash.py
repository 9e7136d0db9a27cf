"""SimHash near-duplicate detection with deletion-variant signatures.

Two 64-bit fingerprints within 4 bits, cut into three segments, agree in one segment up to one bit: three segments
with two differing bits each would make six. A segment therefore enters the index once per bit position, with that
bit wiped out; linked fingerprints meet under an equal (position, wiped segment) and are verified there.

Segments of 21 bits tell a few million fingerprints apart. For more, the fingerprint is cut finer and several segments
together make an index part: of five segments two agree up to one bit, of six three, and so on. Every layout finds all
links; the one chosen keeps chance meetings rare.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import Tables, map_rows, row_hash
from tierline.llm.components import components

BITS = 64
SEED = 42
#: Fingerprints under one index key that a task compares directly. Keys with more go to the midpoint index.
DIRECT = 4096
#: Index entries that one task makes, about.
ENTRIES = 1_000_000
#: Fingerprints that meet by chance under an index key, about, before the layout gets finer.
MEETINGS = 8
#: Share of the fingerprints that shows which keys are crowded, and the fewest sampled fingerprints that tell.
SAMPLED = 0.01
FEWEST = 32
_STEP = 1 << 16


def fingerprint(text: str | None, shingle_words: int) -> int:
    """Bitwise majority over the XXH64 of all word shingles of the text with A-Z in lower case."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle_words + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    counts = np.zeros(BITS, np.int64)
    for k in range(0, n, _STEP):
        some = zip(starts[k : k + _STEP], stops[k : k + _STEP], strict=True)
        hashes = [xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in some]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, row_hash, fp) for every row; ``fp`` holds the 64 bits as a long."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [fingerprint(t, shingle_words) for t in batch.column("text").to_pylist()]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_hash"), fp], ["doc_id", "row_hash", "fp"]
            )

        return work

    rows = docs.select(F.col("doc_id").cast("long"), row_hash(docs.columns).alias("row_hash"), F.col("text").cast("string"))
    return map_rows(rows, make, "doc_id long, row_hash long, fp long")


def _parts(distance: int, extra: int) -> list[int]:
    """Bit masks of which one holds at most one differing bit.

    ``extra`` 0: the fewest segments. Else distance + ``extra`` segments, in unions of ``extra`` + 1: the differing bits leave
    at least ``extra`` segments untouched if each of the others has one, and more if one has several.
    """
    n, m = (distance // 2 + 1, 1) if not extra else (distance + extra, extra + 1)
    cuts = [BITS * k // n for k in range(n + 1)]
    segments = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    return [sum(union) for union in combinations(segments, m)]


def _layout(distance: int, fingerprints: int) -> list[int]:
    """The parts with the fewest index entries under which chance meetings stay below ``MEETINGS`` a key."""
    extra = 0
    while extra < 8 and fingerprints > MEETINGS << (min(m.bit_count() for m in _parts(distance, extra)) - 1):
        extra += 1
    return _parts(distance, extra)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _variant_keys(distinct: DataFrame, parts: list[int]) -> DataFrame:
    """(pos, part, fp): one index entry for each part and bit of it, holding the part without that bit."""
    masks = [_signed(m & ~(1 << i)) for m in parts for i in range(BITS) if m >> i & 1]
    array = F.array(*[F.lit(m).cast("long") for m in masks])
    return distinct.select("fp", F.posexplode(array).alias("pos", "mask")).select(
        F.col("pos").cast("short").alias("pos"), F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "fp"
    )


def _stars(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges from the least of what is connected among the members to the rest of it, found over verified links."""
    edges, rest = [], members
    while rest.size:
        group, front, rest = [rest[:1]], [rest[0]], rest[1:]
        while front and rest.size:
            near = np.bitwise_count(rest ^ front.pop()) <= distance
            if near.any():
                hit = rest[near]
                group.append(hit)
                front += list(hit)
                rest = rest[~near]
        if len(group) > 1:
            reached = np.concatenate(group)
            edges += [(reached.min(), x) for x in reached if x != reached.min()]
    return edges


def _verified(groups: DataFrame, distance: int) -> DataFrame:
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column("fps")
            values = np.asarray(lists.flatten()).astype(np.int64).view(np.uint64)
            stops = np.cumsum(np.asarray(lists.value_lengths()))
            starts = np.concatenate([[0], stops[:-1]])
            two = starts[stops - starts == 2]
            a, b = values[two], values[two + 1]
            near = np.bitwise_count(a ^ b) <= distance
            left, right = [a[near]], [b[near]]
            more = stops - starts > 2
            for i, j in zip(starts[more], stops[more], strict=True):
                if edges := _stars(values[i:j], distance):
                    pairs = np.array(edges, np.uint64)
                    left.append(pairs[:, 0])
                    right.append(pairs[:, 1])
            arrays = [pa.array(np.concatenate(x).astype(np.uint64).view(np.int64)) for x in (left, right)]
            return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

        return work

    return map_rows(groups.select("fps"), make, "a long, b long")


def _midpoint_edges(crowded: DataFrame, distance: int) -> DataFrame:
    """Edges among fingerprints of crowded keys, without comparing them in pairs.

    Fingerprints within ``distance`` bits have a value within half of it from both. Every fingerprint is listed under
    all values within that half; those under one value are within ``distance`` of each other, so an edge from each to
    the least of them is a link, and no link is missed. Rows grow in proportion to the crowded fingerprints.
    """
    half = distance // 2
    masks = {0}
    for _ in range(half):
        masks |= {m ^ (1 << i) for m in masks for i in range(BITS)}
    array = F.array(*[F.lit(_signed(m)).cast("long") for m in sorted(masks)])
    listed = crowded.select("fp", F.explode(array).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("middle"), "fp"
    )
    hubs = listed.groupBy("middle").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    edges = listed.join(hubs.drop("n"), "middle").filter("fp <> hub")
    return edges.select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()


def _crowded_keys(distinct: DataFrame, parts: list[int], direct: int) -> DataFrame:
    """Keys that a sample of the fingerprints shows to be crowded; one missed is found when its entries are counted.

    Their entries need not meet in one task. At most one key for every ``FEWEST`` sampled entries.
    """
    seen = _variant_keys(distinct.sample(SAMPLED, seed=SEED), parts).groupBy("pos", "part").agg(F.count("*").alias("n"))
    return seen.filter(F.col("n") > max(FEWEST, direct * SAMPLED)).select("pos", "part")


def links(distinct: DataFrame, distance: int, tables: Tables, direct: int = DIRECT) -> DataFrame:
    """Edges (a, b) between distinct fingerprints within ``distance`` bits that connect all linked fingerprints."""
    if distance < 0 or distance % 2:
        raise ValueError("distance must be even: two fingerprints at an odd bound need not share a middle value")
    n = distinct.count()
    parts = _layout(distance, n)
    # A few bytes a row become many entries: dealt out first, so that a task's table of entries stays small.
    tasks = -(-n * sum(m.bit_count() for m in parts) // ENTRIES) or 1
    keys = _variant_keys(distinct.repartition(tasks), parts)
    known = tables.write(_crowded_keys(distinct, parts, direct), "crowded_keys")
    some_known = not known.isEmpty()
    # Entries move once. Those of crowded keys do not move at all, as far as a sample shows which these are.
    moved = keys.join(F.broadcast(known), ["pos", "part"], "left_anti") if some_known else keys
    key = Window.partitionBy("pos", "part")
    met = moved.select(
        "*", F.count("*").over(key).alias("n"), F.min("fp").over(key).alias("a"), F.max("fp").over(key).alias("b")
    )
    # A key of two is a pair already, and most of those that meet by chance end here.
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pair = (F.col("n") == 2) & near & (F.col("fp") == F.col("a"))
    shared = tables.write(met.filter((F.col("n") > 2) | pair), "keys")
    several = shared.filter((F.col("n") > 2) & (F.col("n") <= direct))
    groups = several.groupBy("pos", "part").agg(F.collect_list("fp").alias("fps"))
    edges = shared.filter("n = 2").select("a", "b").union(_verified(groups, distance))
    found = shared.filter((F.col("n") > direct) & (F.col("n") > 2)).select("fp")
    if some_known:
        found = found.union(keys.join(F.broadcast(known), ["pos", "part"], "left_semi").select("fp"))
    crowded = tables.write(found.distinct(), "crowded")
    if not crowded.isEmpty():
        edges = edges.union(_midpoint_edges(crowded, distance))
    return edges


def classes(docs: DataFrame, shingle_words: int = 4, distance: int = 4, direct: int = DIRECT) -> DataFrame:
    """Near-duplicate classes of whole documents: (doc_id, row_hash, fp, component, component_id).

    Two documents are linked if their fingerprints differ in at most ``distance`` (even) bits; a class is what links
    connect. ``component`` is the class's least fingerprint, ``component_id`` its least doc_id.

    NULL and blank texts have fingerprint zero and link like any other. Documents with fewer words than a shingle are
    one shingle. Rows with equal doc_id count as documents of their own; a NULL doc_id never is a component_id unless the
    whole class has none. Other columns of ``docs`` are ignored, whatever their names. No rows give no rows.

    Equal fingerprints are merged before anything else, so exact copies cost nothing; keys shared by more than
    ``direct`` distinct fingerprints use the midpoint index, so no task compares an unbounded group.
    """
    tables = Tables(docs.sparkSession)
    found = tables.write(fingerprints(docs, shingle_words), "fingerprints")
    distinct = tables.write(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    groups = components(links(distinct.select("fp"), distance, tables, direct), tables)
    named = tables.write(
        distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
            "component", F.coalesce("component", "fp")
        ),
        "classes",
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(named.select("fp", "component").join(least, "component"), "fp")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """One document of each near-duplicate class: the one with the least doc_id (NULL last, ties by row hash).

    Columns and their order stay. Of rows equal in every column one stays. See ``classes`` for edge cases.
    """
    tables = Tables(docs.sparkSession)
    rows = tables.write(classes(docs, shingle_words, distance).select("doc_id", "row_hash", "component"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash")
    first = rows.groupBy("component").agg(F.min(order).alias("first"))
    gone = rows.join(first, "component").filter(F.col("row_hash") != F.col("first.row_hash")).select("row_hash").distinct()
    mark = "row_hash_of_document"
    kept = docs.withColumn(mark, row_hash(docs.columns)).join(
        gone.withColumnRenamed("row_hash", mark), mark, "left_anti"
    )
    if not rows.groupBy("row_hash").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates([mark])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
