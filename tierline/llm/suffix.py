"""Repeated byte strings by a column-wise collection transform.

Whole documents would make the construction as long as the longest text and as large as the corpus. So documents are
cut into reads first: every window of ``size`` bytes goes to the read of its least-hashed short substring (its
minimizer), and equal windows have equal minimizers. Reads whose minimizer stands once in the corpus hold no repeat.
For the others, grouped by minimizer, a task builds the Burrows-Wheeler transform and the longest common prefixes of a
bounded collection of reads, one symbol of every read a round, the last symbol first: a round streams the transform,
the prefixes and the owners from one file and writes them, with the new suffixes put in place, to the next. Neighbours
with a common prefix of ``size`` bytes are equal windows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Tables, map_rows, row_hash

#: Bytes of a string that counts as repeated, and of the substrings that group windows.
SIZE, SEED_BYTES = 100, 32
#: Windows of a read, at most; reads of a collection; reads of a minimizer beyond which windows are grouped by hash.
READ_WINDOWS, COLLECTION, CROWDED = 100, 4_000, 100_000
_BASE = 0x9E3779B97F4A7C15 | 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every substring of ``size`` (a power of two) bytes: halves are joined until they are long enough."""
    h, length, power = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    while length < size:
        h = h[:-length] * np.uint64(power) + h[length:]
        power = power * power % (1 << 64)
        length *= 2
    return _mixed(h)


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        h = np.minimum(h[:-length], h[length:])
        length *= 2
    return np.minimum(h[: len(h) - (width - length)], h[width - length :]) if width > length else h


def reads(data: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Key, first window, number of windows, occurrences of the key, and where the first of these begins in the read."""
    if len(data) < size:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none
    seed_bytes = _seed_bytes(size)
    h = _rolling(data, seed_bytes)
    keys = _sliding_least(h, size - seed_bytes + 1)
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    first = np.concatenate([[0], cuts])
    count = np.diff(np.concatenate([first, [len(keys)]]))
    if count.max() > READ_WINDOWS:
        parts = -(-count // READ_WINDOWS)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + inner * READ_WINDOWS
        count = np.diff(np.concatenate([first, [len(keys)]]))
    key = keys[first]
    # Places of all keys' substrings, by key and place; a read's own are those of its key within its bytes.
    known, rank = np.unique(key, return_inverse=True)
    near = np.minimum(np.searchsorted(known, h), len(known) - 1)
    at = np.flatnonzero(known[near] == h)
    span = len(data) + 1
    places = np.sort(near[at] * span + at)
    low = np.searchsorted(places, rank * span + first)
    high = np.searchsorted(places, rank * span + first + count - 1 + size - seed_bytes, side="right")
    return key, first, count, high - low, places[low] - rank * span - first


def _seed_bytes(size: int) -> int:
    """The largest power of two that leaves room to slide, up to ``SEED_BYTES``."""
    return min(SEED_BYTES, 1 << max(0, (size // 3).bit_length() - 1))


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(
        row_hash(docs.columns).alias("row_hash"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _listed(rows: DataFrame, size: int) -> DataFrame:
    """(key, row_hash, span) for every read; span holds its first window and, a byte each from the low end, its windows,
    the occurrences of its key (255 for more), and the place of the first of these."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list[np.ndarray]] = [[], [], []]
            for r, text in enumerate(batch.column("text").to_pylist()):
                key, first, count, hits, place = reads(np.frombuffer(_bytes(text), np.uint8), size)
                span = first << 24 | np.minimum(place, 255) << 16 | np.minimum(hits, 255) << 8 | count
                for column, x in zip(out, (key.view(np.int64), span, np.full(len(key), r)), strict=True):
                    column.append(x)
            key, span, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
            hashes = batch.column("row_hash").take(pa.array(at.astype(np.int32)))
            return pa.RecordBatch.from_arrays([pa.array(key), hashes, pa.array(span)], ["key", "row_hash", "span"])

        return work

    return map_rows(rows.select("row_hash", "text"), make, "key long, row_hash long, span long")


def _packed(rows: DataFrame) -> DataFrame:
    """Rows with their text compressed, for the shuffles that move whole texts."""

    def make():
        pack = zstandard.ZstdCompressor(level=1)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [pack.compress(_bytes(t)) for t in batch.column("text").to_pylist()]
            arrays = [batch.column("row_hash"), batch.column("doc_id"), pa.array(texts, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["row_hash", "doc_id", "packed"])

        return work

    return map_rows(rows, make, "row_hash long, doc_id long, packed binary")


def _cut(members: DataFrame, size: int) -> DataFrame:
    """The bytes of listed reads, from rows (row_hash, doc_id, packed, listed: key and span)."""

    def make():
        unpack = zstandard.ZstdDecompressor()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            key, first, at, cut, seed = [], [], [], [], []
            for r, (packed, listed) in enumerate(zip(batch.column("packed").to_pylist(), batch.column("listed").to_pylist(), strict=True)):
                data = unpack.decompress(packed)
                for x in listed:
                    start, count = x["span"] >> 24, x["span"] & 255
                    # Where the key's substring stands, or -1 if it stands more than once.
                    seed.append(x["span"] >> 16 & 255 if x["span"] >> 8 & 255 == 1 else -1)
                    key.append(x["key"])
                    first.append(start)
                    at.append(r)
                    cut.append(data[start : start + count + size - 1])
            take = pa.array(at, pa.int32())
            arrays = [pa.array(key, pa.int64()), batch.column("row_hash").take(take), batch.column("doc_id").take(take)]
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.array(first, pa.int64()), pa.array(cut, pa.binary()), pa.array(seed, pa.int32())],
                ["key", "row_hash", "doc_id", "first", "read", "seed"],
            )

        return work

    return map_rows(members, make, "key long, row_hash long, doc_id long, first long, read binary, seed int")


def _worth_searching(group: dict[bytes, tuple], size: int) -> list[bytes]:
    """Reads of one key that may hold a window of another, or one twice.

    Reads whose key stands once can only meet with these places laid together. A common window then reaches beyond the
    key's substring by half of what is missing on one side at least; reads that agree with no other there are done.
    """
    if any(p[4] < 0 for p in group.values()):
        return list(group)
    if len(group) < 2:
        return []
    seed_bytes = _seed_bytes(size)
    half = -(-(size - seed_bytes) // 2)
    sides: dict[tuple[bool, bytes], int] = {}
    keys = []
    for read, place in group.items():
        at = place[4]
        own = []
        if at >= half:
            own.append((True, read[at - half : at]))
        if len(read) >= at + seed_bytes + half:
            own.append((False, read[at + seed_bytes : at + seed_bytes + half]))
        for side in own:
            sides[side] = sides.get(side, 0) + 1
        keys.append(own)
    return [read for read, own in zip(group, keys, strict=True) if any(sides[s] > 1 for s in own)]


class _Columns:
    """Arrays of one round on disk: written once from front to back, read once from front to back."""

    def __init__(self, *arrays: np.ndarray):
        self.kinds = [(a.dtype, len(a)) for a in arrays]
        self.file = tempfile.TemporaryFile()
        for a in arrays:
            self.file.write(a.data)

    def read(self) -> list[np.ndarray]:
        self.file.seek(0)
        out = [np.frombuffer(bytearray(self.file.read(kind.itemsize * n)), kind) for kind, n in self.kinds]
        self.file.close()
        return out


def collection_transform(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transform (0 before a read's first symbol), common prefix with the entry before, and owner of all suffixes.

    Suffixes are in lexical order, an ended read before any symbol and before the ended reads after it. An owner is the
    read's number times 1024 plus the suffix's length. Symbols are bytes plus one; UTF-8 has no byte 255. Reads are
    shorter than 255 bytes, so prefixes fit a byte too.
    """
    n = len(texts)
    lengths = np.fromiter(map(len, texts), np.int64, n)
    starts = np.cumsum(lengths) - lengths
    pool = np.frombuffer(b"".join(texts), np.uint8) + np.uint8(1)
    # Empty suffixes first, in the order of reads; nothing is known before them yet.
    state = _Columns(np.zeros(n, np.uint8), np.zeros(n, np.uint8))
    place = np.arange(n)  # of each read's longest suffix so far
    for done in range(int(lengths.max(initial=0))):
        bwt, lcp = state.read()
        growing = np.flatnonzero(lengths > done)
        at = place[growing]
        bwt[at] = pool[starts[growing] + lengths[growing] - done - 1]
        order, slot = _by_symbol(bwt)
        fresh = slot[at]  # entries that are new, counted without the empty suffixes
        is_new = np.zeros(len(order) + 1, bool)
        is_new[fresh] = True
        # The common prefix changes at a new entry and at the one behind it.
        again = np.flatnonzero(is_new[1:-1] | is_new[:-2]) + 1
        low, high = order[again - 1], order[again]
        alike = bwt[low] == bwt[high]
        prefix = np.zeros(len(again), np.uint8)
        prefix[alike] = _range_least(lcp, low[alike] + 1, high[alike]) + np.uint8(1)
        old = np.ones(n + len(order), bool)
        place[growing] = n + fresh
        old[place[growing]] = False
        new_bwt, new_lcp = np.zeros(len(old), np.uint8), np.zeros(len(old), np.uint8)
        new_bwt[old], new_lcp[old] = bwt, lcp
        new_lcp[n + again] = prefix
        state = _Columns(new_bwt, new_lcp)
    bwt, lcp = state.read()
    # Owners: from every read's empty suffix to ever longer ones.
    owner, at, length = np.empty(len(bwt), np.int64), np.arange(n), 0
    _, slot = _by_symbol(bwt)
    read = np.arange(n)
    while len(at):
        owner[at] = (read << 10) | length
        more = bwt[at] > 0
        read, at, length = read[more], n + slot[at[more]], length + 1
    return bwt, lcp, owner


def _by_symbol(bwt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places with a symbol, by symbol and then place: the order of all longer suffixes. And each place's rank there."""
    order = np.argsort(bwt, kind="stable")
    order = order[len(bwt) - np.count_nonzero(bwt) :]
    slot = np.empty(len(bwt), np.int64)
    slot[order] = np.arange(len(order))
    return order, slot


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least value in each closed range."""
    if not len(low):
        return np.zeros(0, values.dtype)
    by = np.argsort(low, kind="stable")
    bounds = np.stack([low[by], high[by] + 1], axis=1).ravel()
    found = np.minimum.reduceat(np.append(values, values[-1:]), bounds)[::2]
    out = np.empty(len(low), values.dtype)
    out[by] = found
    return out


def repeated_windows(texts: list[bytes], doc: np.ndarray, first: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """(read, window, windows) for runs of windows that have an equal one earlier: by ``doc`` rank, then by start."""
    _, lcp, owner = collection_transform(texts)
    joined = lcp >= size
    if not joined.any():
        return
    member = joined | np.append(joined[1:], False)
    group = np.cumsum(~joined)[member]
    read, length = owner[member] >> 10, owner[member] & 1023
    window = np.fromiter(map(len, texts), np.int64, len(texts))[read] - length
    order = np.lexsort((first[read] + window, doc[read], group))
    later = np.concatenate([[False], group[order][1:] == group[order][:-1]])
    read, window = read[order][later], window[order][later]
    code = np.sort(read * 1024 + window)
    runs = np.flatnonzero(np.concatenate([[True], np.diff(code) != 1]))
    for a, b in zip(runs, np.append(runs[1:], len(code)), strict=True):
        yield int(code[a] >> 10), int(code[a] & 1023), int(b - a)


def _searched(cut: DataFrame, size: int) -> DataFrame:
    """(row_hash, first, windows): runs of repeated windows, found among reads sorted by key.

    Equal reads are laid together as they come in; all but the earliest are repeated whole, and one of them enters the
    collection. Whole groups are collected until a collection is full.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[bytes, tuple] = {}  # read -> earliest place of it
        group: dict[bytes, tuple] = {}  # the same for the key at hand
        found: list[tuple[int, int, int]] = []

        def close() -> None:
            for read in _worth_searching(group, size):
                own[read] = group[read]
            group.clear()

        def search() -> None:
            texts, places = list(own), list(own.values())
            rank = {p: k for k, p in enumerate(sorted({x[:3] for x in places}))}
            doc = np.array([rank[p[:3]] for p in places], np.int64)
            first = np.array([p[3] for p in places], np.int64)
            for r, w, n in repeated_windows(texts, doc, first, size):
                found.append((places[r][2], places[r][3] + w, n))
            own.clear()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(x), pa.int64()) for x in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 3
            found.clear()
            return pa.RecordBatch.from_arrays(columns, ["row_hash", "first", "windows"])

        last = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "row_hash", "doc_id", "first", "seed", "read"))
            for key, row, doc, first, seed, read in zip(*columns, strict=True):
                if key != last:
                    close()
                    if len(own) >= COLLECTION:
                        search()
                last = key
                place = (doc is None, doc or 0, row, first, seed)
                before = group.get(read)
                if before is None:
                    group[read] = place
                else:
                    group[read] = min(place, before)
                    late = max(place, before)
                    found.append((late[2], late[3], len(read) - size + 1))
            yield out()
        close()
        if own:
            search()
        yield out()

    return cut.repartition("key").sortWithinPartitions("key").mapInArrow(run, "row_hash long, first long, windows long")


def _crowded(cut: DataFrame, size: int) -> DataFrame:
    """The same for minimizers with too many reads for one collection: windows grouped by a 128-bit hash. Linear."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, first, hashes = [], [], []
            for r, (start, read) in enumerate(zip(batch.column("first").to_pylist(), batch.column("read").to_pylist(), strict=True)):
                for w in range(len(read) - size + 1):
                    at.append(r)
                    first.append(start + w)
                    hashes.append(hashlib.blake2b(read[w : w + size], digest_size=16).digest())
            take = pa.array(at, pa.int32())
            arrays = [batch.column("row_hash").take(take), batch.column("doc_id").take(take), pa.array(first, pa.int64())]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(hashes, pa.binary())], ["row_hash", "doc_id", "first", "h"])

        return work

    windows = map_rows(cut, make, "row_hash long, doc_id long, first long, h binary")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash", "first")
    heads = windows.groupBy("h").agg(F.min(place).alias("head"), F.count("*").alias("n")).filter("n > 1")
    return windows.join(heads, "h").filter(place != F.col("head")).select("row_hash", "first", F.lit(1).cast("long").alias("windows"))


def repeats(docs: DataFrame, size: int = SIZE, tables: Tables | None = None, crowded: int = CROWDED) -> DataFrame:
    """(row_hash, spans): for every row with repeated bytes, [start, end) byte ranges in order, apart from each other.

    A byte is repeated if a string of ``size`` bytes that covers it also starts earlier: in a document before (by doc_id,
    NULL last, then row hash) or earlier in the same one; matches do not cross documents and are judged on the input.
    NULL and short texts have none. Rows equal in every column count as one document.
    """
    tables = tables or Tables(docs.sparkSession)
    rows = _docs(docs)
    # Of rows with equal texts the first stands for all; the others are repeated whole.
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash")
    texts = rows.select(
        "row_hash", "doc_id", F.xxhash64("text").alias("a"), F.md5(F.col("text").cast("binary")).alias("b"), F.octet_length("text").alias("n")
    ).filter(F.col("n") >= size)
    texts = tables.write(texts, "texts")
    firsts = texts.groupBy("a", "b").agg(F.min(place).alias("head"), F.count("*").alias("copies")).filter("copies > 1")
    shared, is_head = texts.join(firsts, ["a", "b"]), F.col("row_hash") == F.col("head.row_hash")
    copies = tables.write(shared.filter(~is_head).select("row_hash", "n").distinct(), "copies")
    # Rows that stand several times are read once.
    twice = tables.write(shared.filter(is_head).groupBy("row_hash").count().filter("count > 1").select("row_hash"), "twice")
    single = rows.join(copies.select("row_hash").union(twice), "row_hash", "left_anti").union(
        rows.join(twice, "row_hash", "left_semi").dropDuplicates(["row_hash"])
    )
    # Written, so that texts are listed once for the count and the look-up.
    listed = tables.write(_listed(single, size), "listed")
    # The reads of a key in two places or more.
    hits = F.shiftright("span", 8).bitwiseAND(255)
    counted = listed.groupBy("key").agg(F.sum(hits).alias("hits"), F.count("*").alias("reads")).filter("hits > 1")
    wanted = tables.write(
        listed.join(counted, "key").groupBy("row_hash").agg(F.collect_list(F.struct("key", "span", "reads")).alias("listed")), "wanted"
    )
    tables.drop(listed)
    members = _packed(single).join(wanted, "row_hash")
    few = F.filter("listed", lambda x: x["reads"] <= crowded)
    runs = _searched(_cut(members.withColumn("listed", few), size), size)
    if not wanted.filter(F.exists("listed", lambda x: x["reads"] > crowded)).isEmpty():
        many = F.filter("listed", lambda x: x["reads"] > crowded)
        runs = runs.union(_crowded(_cut(members.withColumn("listed", many), size), size))
    spans = runs.select("row_hash", F.struct(F.col("first").alias("start"), (F.col("first") + F.col("windows") + size - 1).alias("end")).alias("span"))
    spans = spans.union(copies.select("row_hash", F.struct(F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("end"))))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            merged = []
            for spans in batch.column("spans").to_pylist():
                out: list[list[int]] = []
                for start, end in sorted((s["start"], s["end"]) for s in spans):
                    if out and start <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], end)
                    else:
                        out.append([start, end])
                merged.append([{"start": a, "end": b} for a, b in out])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays([batch.column("row_hash"), pa.array(merged, kind)], ["row_hash", "spans"])

        return work

    grouped = spans.groupBy("row_hash").agg(F.collect_list("span").alias("spans"))
    return map_rows(grouped, make, "row_hash long, spans array<struct<start:long,end:long>>")


def without_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per document: (doc_id, spans removed, kept bytes, n_bytes). See ``repeats`` for edge cases."""
    tables = Tables(docs.sparkSession)
    found = tables.write(repeats(docs, size, tables), "spans")
    joined = _packed(_docs(docs)).join(found, "row_hash", "left")

    def make():
        unpack = zstandard.ZstdDecompressor()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans, kept, sizes = batch.column("spans").to_pylist(), [], []
            for packed, gone in zip(batch.column("packed").to_pylist(), spans, strict=True):
                data = unpack.decompress(packed)
                sizes.append(len(data))
                at, out = 0, []
                for s in gone or ():
                    out.append(data[at : s["start"]])
                    at = s["end"]
                kept.append(b"".join([*out, data[at:]]))
            arrays = [batch.column("doc_id"), batch.column("spans"), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "spans", "kept", "n_bytes"])

        return work

    return map_rows(
        joined.select("doc_id", "spans", "packed"), make, "doc_id long, spans array<struct<start:long,end:long>>, kept binary, n_bytes long"
    )
