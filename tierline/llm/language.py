"""Language identification by compression with per-language dictionaries.

A text is encoded once with each language's dictionary of raw sample text; the language whose dictionary saves most is
chosen, and the choice is rejected when the next best is nearly as short.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import map_rows

UNDETERMINED = "und"
#: The classifier is fitted on a bounded sample: texts per language, and code points taken of each.
SAMPLE_TEXTS, SAMPLE_CHARS = 512, 1024
#: A language's least hashes are sought in so many parts, then among the finds in fewer: a task of a later step gets
#: ``sample_texts`` of sixteen parts at most, so a common language is no single large task.
PARTS = (256, 16, 1)
#: Compression level; bytes encoded at a time, so that the dictionary counts throughout a long text.
LEVEL, BLOCK = 6, 4096
#: Choices are rejected where the second best size is less than this share larger.
MIN_MARGIN = 0.01


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _plain(text: str) -> bytes:
    """Lower-case letters, whatever stands between them as one space: marks and numbers belong to no language."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


@dataclass(frozen=True)
class Dictionaries:
    by_language: dict[str, bytes]
    level: int = LEVEL


def fit(labelled: DataFrame, sample_texts: int = SAMPLE_TEXTS, sample_chars: int = SAMPLE_CHARS) -> Dictionaries:
    """Dictionaries from (text, lang): for each language a sample of at most ``sample_texts`` different texts.

    The sample are the texts of least hash, ``sample_chars`` code points from the middle of each. Rows
    without a language or without a letter teach nothing; no such rows give no dictionaries. Copies count once and are
    merged before the shuffle. The hashes are chosen first, in steps and without their texts, and their texts looked
    up by a list of ``sample_texts`` hashes a language; only the sample reaches the driver.
    """
    start = F.greatest(F.floor((F.length("text") - sample_chars) / 2).cast("int") + 1, F.lit(1))
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashes = usable.select("lang", F.xxhash64("text").alias("h")).distinct()
    for parts in PARTS:
        n = F.row_number().over(Window.partitionBy("lang", F.pmod("h", F.lit(parts))).orderBy("h"))
        hashes = hashes.withColumn("n", n).filter(F.col("n") <= sample_texts)
    texts = labelled.filter(F.col("lang").isNotNull()).select("lang", F.xxhash64("text").alias("h"), "text")
    sample = (
        texts.join(F.broadcast(hashes), ["lang", "h"])
        .groupBy("lang", "n")
        .agg(F.min(F.substring("text", start, F.lit(sample_chars))).alias("part"))
    )
    parts: dict[str, list[tuple[int, str]]] = {}
    for r in sample.select("lang", "n", "part").collect():
        parts.setdefault(r["lang"], []).append((r["n"], r["part"]))
    return Dictionaries({k: _plain(" ".join(t for _, t in sorted(v))) for k, v in sorted(parts.items())})


class _Sizer:
    def __init__(self, model: Dictionaries):
        self.coders = {}
        for language, sample in model.by_language.items():
            data = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=model.level)
            self.coders[language] = zstandard.ZstdCompressor(
                level=model.level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
            )

    def __call__(self, text: str) -> dict[str, int]:
        """Encoded size of the whole text with each language's dictionary."""
        data = _plain(text)
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        return {language: sum(len(c.compress(b)) for b in blocks) for language, c in self.coders.items()}


def choose(sizes: dict[str, int], min_margin: float) -> tuple[str, float, bool]:
    """Language of the least size (ties: the first by name), score, and whether the margin is too narrow.

    The score is 1/2 where the two best tie and nears 1 as the second best gets larger; a single language scores 1.
    """
    ranked = sorted(sizes.items(), key=lambda x: (x[1], x[0]))
    if len(ranked) == 1:
        return ranked[0][0], 1.0, False
    margin = (ranked[1][1] - ranked[0][1]) / ranked[0][1]
    return ranked[0][0], 1 - 0.5 / (1 + 50 * margin), margin < min_margin


def identify(docs: DataFrame, model: Dictionaries, min_margin: float = MIN_MARGIN) -> DataFrame:
    """Language of every whole text: (doc_id, language, nearest, score, rejected).

    ``nearest`` is the language that encodes the text shortest, ``language`` the same or ``und`` where the margin is too
    narrow. NULL texts, texts without a letter, and all texts under a model without languages are ``und`` in both, with
    score 0. Only ``doc_id`` and ``text`` are read; rows are judged one by one, repeated ones alike.
    """

    def make():
        sizer = _Sizer(model)

        def one(text: str | None) -> tuple[str, str, float, bool]:
            if not sizer.coders or not text or not any(map(str.isalpha, text)):
                return UNDETERMINED, UNDETERMINED, 0.0, True
            nearest, score, narrow = choose(sizer(text), min_margin)
            return UNDETERMINED if narrow else nearest, nearest, score, narrow

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = zip(*map(one, batch.column("text").to_pylist()), strict=True)
            kinds = (pa.string(), pa.string(), pa.float64(), pa.bool_())
            arrays = [pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "language", "nearest", "score", "rejected"])

        return work

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_rows(rows, make, "doc_id long, language string, nearest string, score double, rejected boolean")
