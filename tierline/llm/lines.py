"""Line dedup across documents: exact repeats by hash, near repeats by a segment-partition edit join.

A line of length n is cut into threshold + 1 segments. A line within the threshold keeps one of them whole, at a
position the edits can have moved it to; so every line lists its own segments and, for each shorter length it could
match, the substrings at those positions. Lines meet under equal (length, segment number, text), and a banded
bit-parallel edit distance verifies them there.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Tables, map_rows, row_hash
from tierline.llm.components import components

#: Edits between linked lines, at most, and code points of the shorter line for each of them.
MAX_EDITS, CHARS_AN_EDIT = 2, 8
#: Shortest line compared at all (every line with a word), and by edits (code points).
MIN_CHARS, MIN_NEAR_CHARS = 1, CHARS_AN_EDIT
#: Lines and characters that one comparison task holds. Larger groups are compared block against block.
BLOCK_LINES, BLOCK_CHARS = 1024, 2_000_000
_BAGS = 32
_BLANK = " \t\x0b\x0c\r"


def within(a: str, b: str, k: int) -> bool:
    """Whether at most ``k`` insertions, deletions and substitutions turn one text into the other.

    One bit vector per error count; bit x of it stands for the prefix of ``a`` that is k - x shorter than what was
    read of ``b``. The band of 2k + 1 bits moves along with ``b``.
    """
    if abs(len(a) - len(b)) > k:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[same:], b[same:]
    band = (1 << (2 * k + 1)) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << (i + k + 1))
    # Prefix of length i stands at bit i - j + k; before anything is read, prefix i costs i errors.
    rows = [((1 << (k + d + 1)) - 1) & ~((1 << k) - 1) for d in range(k + 1)]
    for j, c in enumerate(b, 1):
        hit = (where.get(c, 0) >> j) & band
        before, last = 0, 0
        for d in range(k + 1):
            old = rows[d]
            new = (old & hit) | (before >> 1) | before | ((last << 1) & band) if d else old & hit
            rows[d], before, last = new, old, new
        if not rows[k]:
            return False
    end = len(a) - len(b) + k
    return bool((rows[k] >> end) & 1)


def segments(length: int, k: int) -> list[tuple[int, int]]:
    """Start and length of the k + 1 segments of a line; the later ones are longer by one where it doesn't divide."""
    small, longer = divmod(length, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = small + (i >= k + 1 - longer)
        out.append((at, size))
        at += size
    return out


def allowed(length: int, most: int, chars_an_edit: int) -> int:
    """Edits that a pair of lines may differ by, from the length of the shorter one."""
    return min(most, length // chars_an_edit)


def probes(line: str, most: int, chars_an_edit: int = 1) -> list[tuple[int, int]]:
    """Index keys of a line: (64-bit key, 1 if it is a segment of the line itself, else 0).

    For an indexed length and segment, edits before the segment move it by at most its number, and edits after it by at
    most what is left; only starts that both allow are listed. The edits allowed are those of the indexed length.
    """
    n, out = len(line), []
    for length in range(max(n - most, 1), n + 1):
        shift, k = n - length, allowed(length, most, chars_an_edit)
        if shift > k or length <= k:
            continue
        for i, (start, size) in enumerate(segments(length, k)):
            low = max(start - i, start + shift - (k - i), 0)
            high = min(start + i, start + shift + (k - i), n - size)
            head = f"{length},{i},"
            for at in range(low, high + 1):
                key = xxhash.xxh64_intdigest((head + line[at : at + size]).encode("utf-8", "replace"))
                out.append((key, int(not shift and at == start)))
    return out


def _cut(text: str | None) -> list[str]:
    return [line.strip(_BLANK) for line in text.split("\n")] if text else []


def _digest(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "replace"))


def _short(lid: bytes) -> int:
    """63 bits of a line's digest, for the candidate search only."""
    return int.from_bytes(lid[:8], "little") >> 1


def _longs(values: array | list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def all_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(row_hash, doc_id, line_no, lid) for every line long enough; lid is the line's 128-bit hash."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, numbers, lids = [], [], []
            for r, text in enumerate(batch.column("text").to_pylist()):
                for i, line in enumerate(_cut(text)):
                    if len(line) >= min_chars:
                        at.append(r)
                        numbers.append(i)
                        lids.append(_digest(line))
            take = pa.array(at, pa.int32())
            return pa.RecordBatch.from_arrays(
                [batch.column("row_hash").take(take), batch.column("doc_id").take(take), pa.array(numbers, pa.int32()), pa.array(lids, pa.binary())],
                ["row_hash", "doc_id", "line_no", "lid"],
            )

        return work

    return map_rows(_rows(docs), make, "row_hash long, doc_id long, line_no int, lid binary")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        row_hash(docs.columns).alias("row_hash"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )


def _index(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(key, entry): entry is the short line number, doubled, plus one where the key is the line's own segment."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            lines = {line for text in batch.column("text").to_pylist() for line in _cut(text) if len(line) >= min_chars}
            keys, entries = array("Q"), array("Q")
            for line in lines:
                short = _short(_digest(line)) << 1
                for key, own in probes(line, edits, CHARS_AN_EDIT):
                    keys.append(key)
                    entries.append(short | own)
            return pa.RecordBatch.from_arrays([_longs(keys), _longs(entries)], ["key", "entry"])

        return work

    return map_rows(_rows(docs), make, "key long, entry long")


def _texts(docs: DataFrame, min_chars: int) -> DataFrame:
    """(short, lid, line) for the distinct lines of each batch."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            lines = {line for text in batch.column("text").to_pylist() for line in _cut(text) if len(line) >= min_chars}
            lines = [line.encode("utf-8", "replace").decode() for line in lines]
            lids = [_digest(line) for line in lines]
            arrays = [_longs([_short(x) for x in lids]), pa.array(lids, pa.binary()), pa.array(lines, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["short", "lid", "line"])

        return work

    return map_rows(_rows(docs), make, "short long, lid binary, line string")


def _bags(lines: list[str]) -> np.ndarray:
    """Counts of characters in a few classes. An edit changes two counts by one at most."""
    out = np.zeros((len(lines), _BAGS), np.int16)
    for i, line in enumerate(lines):
        codes = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32)
        out[i] = np.minimum(np.bincount(codes % _BAGS, minlength=_BAGS), 30_000)
    return out


def _stars(lids: list[bytes], lines: list[str], edits: int) -> list[tuple[bytes, bytes]]:
    """Edges from the least of what is linked within a group to the rest of it. A line leaves the search once it is
    reached; pairs whose characters differ too much in number are not compared."""
    bags = _bags(lines)
    found, rest = [], np.arange(len(lines))
    while rest.size:
        group, front, rest = [rest[0]], [rest[0]], rest[1:]
        while front and rest.size:
            x = front.pop()
            alike = np.abs(bags[rest] - bags[x]).sum(axis=1) <= 2 * edits
            if not alike.any():
                continue
            hit = np.array(
                [within(lines[x], lines[y], allowed(min(len(lines[x]), len(lines[y])), edits, CHARS_AN_EDIT)) for y in rest[alike]]
            )
            reached = rest[alike][hit]
            group += list(reached)
            front += list(reached)
            keep = np.ones(rest.size, bool)
            keep[np.flatnonzero(alike)[hit]] = False
            rest = rest[keep]
        least = min(lids[x] for x in group)
        found += [(least, lids[x]) for x in group if lids[x] != least]
    return found


def near_links(docs: DataFrame, edits: int, min_chars: int, tables: Tables, block_lines: int, block_chars: int) -> DataFrame:
    """Links (a, b) between different lines within ``allowed`` edits that connect all lines so linked."""
    listed = _index(docs, edits, min_chars).repartition("key")
    line = F.shiftrightunsigned("entry", 1)
    shared = listed.groupBy("key").agg(
        F.min(line).alias("low"), F.max(line).alias("high"), F.max(F.col("entry").bitwiseAND(1)).alias("own")
    )
    members = tables.write(
        listed.join(shared.filter("own = 1 and low <> high").select("key"), "key")
        .select("key", line.alias("short"))
        .distinct(),
        "members",
    )
    texts = tables.write(
        _texts(docs, min_chars)
        .join(members.select("short").distinct(), "short", "left_semi")
        .dropDuplicates(["short", "lid"]),
        "texts",
    )
    sized = members.join(texts.select("short", F.length("line").alias("n")), "short")
    per_key = sized.groupBy("key").agg(F.count("*").alias("lines"), F.sum("n").alias("chars"))
    # A group within the limits is one block; others get as many as keep two blocks within them.
    blocks = F.greatest(F.ceil(2 * F.col("lines") / block_lines), F.ceil(2 * F.col("chars") / block_chars))
    blocks = F.when((F.col("lines") <= block_lines) & (F.col("chars") <= block_chars), 1).otherwise(blocks).cast("int")
    numbered = members.join(per_key.select("key", blocks.alias("blocks")), "key").withColumn(
        "mine", F.pmod(F.xxhash64("short"), F.col("blocks")).cast("int")
    )
    # Every block meets every block once: a line goes to the pairs (mine, x) and (x, mine).
    paired = numbered.select(
        "key", "short", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("key", "short", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    groups = paired.join(texts, "short").groupBy("key", "i", "j").agg(F.collect_list(F.struct("lid", "line")).alias("lines"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            links: set[tuple[bytes, bytes]] = set()
            for group in batch.column("lines").to_pylist():
                links.update(_stars([x["lid"] for x in group], [x["line"] for x in group], edits))
            pairs = list(links)
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], ["a", "b"]
            )

        return work

    return map_rows(groups.select("lines"), make, "a binary, b binary")


def repeated_lines(
    docs: DataFrame,
    edits: int = MAX_EDITS,
    min_chars: int = MIN_CHARS,
    min_near_chars: int = MIN_NEAR_CHARS,
    block_lines: int = BLOCK_LINES,
    block_chars: int = BLOCK_CHARS,
    tables: Tables | None = None,
) -> DataFrame:
    """Lines that repeat an earlier one: (row_hash, doc_id, line_no, exact, class_doc, class_line).

    Lines are cut at line feeds and stripped of blanks. Equal lines of at least ``min_chars`` code points are of one class,
    and so are lines of at least ``min_near_chars`` that a few edits turn into each other, directly or through others: one
    for every ``CHARS_AN_EDIT`` code points of the shorter line, up to ``edits``. The first line of a class, by doc_id (NULL last), row hash and line number, stays; all others are returned,
    with the place of the first; ``exact`` tells whether an equal line came earlier.

    NULL texts and lines without a word repeat nothing. Rows equal in every column count as one document. Other columns of
    ``docs`` only tell rows apart. No rows give no rows.
    """
    tables = tables or Tables(docs.sparkSession)
    lines = tables.write(all_lines(docs, min_chars).distinct(), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash", "line_no")
    per_line = lines.groupBy("lid").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    links = near_links(docs, edits, max(min_near_chars, min_chars), tables, block_lines, block_chars)
    groups = components(links, tables).withColumnRenamed("node", "lid")
    classed = tables.write(
        per_line.join(groups, "lid", "left").withColumn("component", F.coalesce("component", "lid")),
        "classes",
    )
    heads = classed.groupBy("component").agg(F.sum("n").alias("all"), F.min("first").alias("head")).filter(F.col("all") > 1)
    named = classed.join(heads, "component").select("lid", "first", "head")
    here = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash", "line_no")
    return (
        lines.join(named, "lid")
        .filter(here != F.col("head"))
        .select(
            "row_hash", "doc_id", "line_no", (here != F.col("first")).alias("exact"),
            F.col("head.doc_id").alias("class_doc"), F.col("head.line_no").alias("class_line"),
        )
    )


def drop_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without lines that repeat an earlier one, wherever that stands; columns and their order stay.

    A document of which every line with a word was removed is a copy of others and goes; documents that had no such line
    stay as they are. ``n_chars``, where there is one, is counted anew for changed texts. See ``repeated_lines``.
    """
    tables = Tables(docs.sparkSession)
    gone = repeated_lines(docs, tables=tables, **options).groupBy("row_hash").agg(F.collect_list("line_no").alias("gone"))
    mark, lines = "row_hash_of_document", "removed_lines_of_document"
    joined = docs.withColumn(mark, row_hash(docs.columns)).join(
        gone.select(F.col("row_hash").alias(mark), F.col("gone").alias(lines)), mark, "left"
    )
    split = F.split("text", "\n", -1)
    kept = F.filter(split, lambda _, i: ~F.array_contains(F.col(lines), i))
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    changed = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed = changed.withColumn(
            "n_chars", F.when(F.col(lines).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        )
    return changed.filter(F.col(lines).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_lines, n_exact, n_near, first_class_doc (least document a line repeats).

    Rows equal in every column give equal rows. See ``repeated_lines``.
    """
    tables = Tables(docs.sparkSession)
    gone = repeated_lines(docs, tables=tables, **options)
    per_doc = gone.groupBy("row_hash").agg(
        F.count_if("exact").alias("n_exact"), F.count_if(~F.col("exact")).alias("n_near"), F.min("class_doc").alias("class_doc")
    )
    rows = docs.select(
        row_hash(docs.columns).alias("row_hash"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.size(F.split(F.col("text").cast("string"), "\n", -1)), F.lit(0)).alias("n_lines"),
    )
    return rows.join(per_doc, "row_hash", "left").select(
        "doc_id",
        F.col("n_lines").cast("long"),
        F.coalesce("n_exact", F.lit(0)).cast("long").alias("n_exact"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "class_doc",
    )
