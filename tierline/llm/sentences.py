"""Substring dedup over sliding runs of sentences.

Every run of consecutive sentences is hashed; runs with equal hashes anywhere in the corpus are joined, and all
sentences that a repeated run other than its first occurrence covers are removed.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import WORD, Tables, map_rows, row_hash

#: Sentences of a run, at least, and words it has at least: a run goes on until it has both.
RUN_SENTENCES, RUN_WORDS = 2, 12
#: Runs that hold over one in so many of all repeated ones are joined with their heads by broadcast: fewer than this many.
HOT = 4096
#: A sentence ends at a line feed, or at a point, exclamation or question mark with white space behind it.
_END = re.compile(r"(?<=[.!?])[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*")
_WORDS = re.compile(WORD)
_BLANK = " \t\n\x0b\x0c\r"


def cut(text: str | None) -> list[tuple[int, int]]:
    """Start and end of the sentences of a text, without the white space around them; none is empty."""
    if not text:
        return []
    out, at = [], 0
    for m in _END.finditer(text):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, len(text)))
    trimmed = []
    for a, b in out:
        body = text[a:b]
        left = len(body) - len(body.lstrip(_BLANK))
        body = body.strip(_BLANK)
        if body:
            trimmed.append((a + left, a + left + len(body)))
    return trimmed


def _ahead(counts: list[int], least: int, words: int) -> list[tuple[int, int]]:
    """For every sentence, the shortest run from it on with enough sentences and words: (first, sentences)."""
    out, end, held = [], 0, 0
    for i in range(len(counts)):
        while end < len(counts) and (end - i < least or held < words):
            held += counts[end]
            end += 1
        if end - i < least or held < words:
            break
        out.append((i, end - i))
        held -= counts[i]
    return out


def runs(sentences: list[str], least: int, words: int) -> list[tuple[int, int]]:
    """The shortest run from every sentence on and up to every sentence: (first, sentences).

    They cover whatever longer runs cover: of a longer run, the shortest ones from its sentences on lie inside, but for its
    last sentences, and the shortest one up to its end holds those. Too short a text is one run.
    """
    counts = [len(_WORDS.findall(s)) for s in sentences]
    back = {(len(counts) - i - n, n) for i, n in _ahead(counts[::-1], least, words)}
    found = back.union(_ahead(counts, least, words))
    return sorted(found) or [(0, len(counts))] * (len(counts) > 0)


def _hashed(docs: DataFrame, least: int, words: int) -> DataFrame:
    """(a, b, row_hash, doc_id, first, count) for every run; a and b are its 128-bit hash."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, first, count, left, right = [], [], [], [], []
            for r, text in enumerate(batch.column("text").to_pylist()):
                sentences = [text[a:b] for a, b in cut(text)]
                for i, n in runs(sentences, least, words):
                    h = xxhash.xxh3_128_intdigest("\n".join(sentences[i : i + n]).encode("utf-8", "replace"))
                    at.append(r)
                    first.append(i)
                    count.append(n)
                    left.append((h >> 64) - (1 << 63))
                    right.append((h & ((1 << 64) - 1)) - (1 << 63))
            take = pa.array(at, pa.int32())
            arrays = [pa.array(left, pa.int64()), pa.array(right, pa.int64()), batch.column("row_hash").take(take)]
            arrays += [batch.column("doc_id").take(take), pa.array(first, pa.int32()), pa.array(count, pa.int32())]
            return pa.RecordBatch.from_arrays(arrays, ["a", "b", "row_hash", "doc_id", "first", "count"])

        return work

    rows = docs.select(row_hash(docs.columns).alias("row_hash"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_rows(rows, make, "a long, b long, row_hash long, doc_id long, first int, count int")


def repeated_sentences(
    docs: DataFrame, least: int = RUN_SENTENCES, words: int = RUN_WORDS, tables: Tables | None = None, hot: int = HOT
) -> DataFrame:
    """(row_hash, doc_id, first_sentence, n_sentences): stretches of sentences to remove, apart from each other.

    A run that also stands earlier (by doc_id, NULL last, then row hash, then sentence) is repeated, also within one
    document; its sentences go, the first occurrence stays. Sentences are numbered from 0. NULL and blank texts repeat nothing;
    a text of fewer sentences or words than a run has is compared whole, with others as short. Rows equal in every column count as one document; other
    columns only tell rows apart. No rows give no rows.
    """
    tables = tables or Tables(docs.sparkSession)
    hashed = tables.write(_hashed(docs, least, words), "runs")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash", "first")
    heads = hashed.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("head")).filter("n > 1")
    heads = tables.write(heads, "heads")
    again = _with_heads(hashed, heads, hot).filter(place != F.col("head"))
    # Runs that overlap or touch are one stretch. A document's runs are at most twice its sentences.
    end = F.col("first") + F.col("count")
    by_place = Window.partitionBy("row_hash", "doc_id").orderBy("first")
    reached = F.max(end).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    apart = again.withColumn("apart", F.coalesce((F.col("first") > reached).cast("int"), F.lit(0)))
    return (
        apart.withColumn("stretch", F.sum("apart").over(by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("row_hash", "doc_id", "stretch")
        .agg(F.min("first").alias("first_sentence"), F.max(end).alias("end"))
        .select("row_hash", "doc_id", "first_sentence", (F.col("end") - F.col("first_sentence")).cast("long").alias("n_sentences"))
    )


def _with_heads(hashed: DataFrame, heads: DataFrame, hot: int) -> DataFrame:
    """Repeated runs with their first occurrence. A run that fills a large share of the corpus is not shuffled: there are
    fewer than ``hot`` of its kind, so their heads are broadcast."""
    total = heads.agg(F.sum("n")).first()[0] or 0
    large = F.col("n") * hot > total
    columns = ["row_hash", "doc_id", "first", "count", "head"]
    common = F.broadcast(heads.filter(large).select("a", "b", "head"))
    rest = hashed.join(common.drop("head"), ["a", "b"], "left_anti").join(heads.filter(~large), ["a", "b"])
    return hashed.join(common, ["a", "b"]).select(*columns).union(rest.select(*columns))


def drop_repeated_sentences(docs: DataFrame, least: int = RUN_SENTENCES, words: int = RUN_WORDS) -> DataFrame:
    """``docs`` without repeated sentences; columns and their order stay, and so does every row.

    A removed stretch takes the white space behind it along. See ``repeated_sentences`` for edge cases.
    """
    tables = Tables(docs.sparkSession)
    found = repeated_sentences(docs, least, words, tables)
    stretch = F.struct(F.col("first_sentence").alias("first"), F.col("n_sentences").alias("count"))
    mark, gone = "row_hash_of_document", "stretches_of_document"
    per_doc = found.groupBy(F.col("row_hash").alias(mark)).agg(F.sort_array(F.collect_list(stretch)).alias(gone))
    joined = docs.withColumn(mark, row_hash(docs.columns)).join(per_doc, mark, "left")

    @F.pandas_udf("string")
    def strip(texts, stretches):
        def one(text, removed):
            if text is None or removed is None:
                return text
            bounds = cut(text)
            out, at = [], 0
            for r in removed:
                out.append(text[at : bounds[r["first"]][0]])
                after = r["first"] + r["count"]
                at = bounds[after][0] if after < len(bounds) else len(text)
            return "".join([*out, text[at:]])

        return texts.combine(stretches, one)

    changed = F.when(F.col(gone).isNull(), F.col("text")).otherwise(strip(F.col("text"), F.col(gone)))
    return joined.withColumn("text", changed).select(*[F.col(f"`{c}`") for c in docs.columns])
