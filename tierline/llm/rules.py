"""Quality rules: an isolation forest over rule statistics of whole documents.

Statistics come from every document. The forest is grown on a bounded sample of labelled rows and its threshold is
set on all labelled rows: documents that random splits isolate early are anomalous, and the threshold is the one that
catches most rows labelled bad while it keeps nearly all rows labelled good.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Tables, blanks, map_rows

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stutter", "n_capitals")
#: What the forest splits on. Repeated lines and windows are left to the base rules and to line dedup.
FEATURES = ("word_length", "symbols_per_word", "stutter_share", "capital_share")

#: Labelled rows the forest is grown on, at most; trees, and rows a tree sees.
SAMPLE_ROWS, TREES, TREE_ROWS = 20_000, 100, 256
#: Rows labelled good that the threshold may reject, as a share of them.
MAX_GOOD_REJECTED = 0.001
_BINS = 4096
_MIX = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, WINDOW_WORDS + 1)], np.uint64)
_BLANK_BYTES = " \t\n\x0b\x0c\r"


def _scrambled(codes: np.ndarray) -> np.ndarray:
    """64 well mixed bits for each word number."""
    x = codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeats(codes: np.ndarray) -> int:
    """Words inside 8-word windows that occur at least twice."""
    n = len(codes) - WINDOW_WORDS + 1
    if n < 2:
        return 0
    values, keys = _scrambled(codes), np.zeros(n, np.uint64)
    for k in range(WINDOW_WORDS):
        keys += values[k : k + n] * _MIX[k]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    reach = np.concatenate([[0], np.cumsum(again)])
    word = np.arange(len(codes))
    return int((reach[np.minimum(word + 1, n)] > reach[np.maximum(word - WINDOW_WORDS + 1, 0)]).sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS``; a NULL text has none of anything."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "replace")
    words = data.split()
    if not words:
        return (0,) * len(COUNTS)
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    lines = [line for line in text.split("\n") if line.strip(_BLANK_BYTES)]
    octets = np.frombuffer(data, np.uint8)
    return (
        len(words),
        len(text) - blanks(text),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeats(codes) if len(ids) < len(words) else 0,
        int((codes[1:] == codes[:-1]).sum()),
        int(((octets - np.uint8(65)) < 26).sum()),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of ``COUNTS``) for every row; whole texts, one pass, no shuffle."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = np.array([statistics(t) for t in batch.column("text").to_pylist()], np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(rows[:, k]) for k in range(len(COUNTS)))], ["doc_id", *COUNTS]
            )

        return work

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_rows(rows, make, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def _features(counts: np.ndarray) -> np.ndarray:
    words, chars, symbols, _, _, stutter, capitals = counts.astype(float).T
    words, chars = np.maximum(words, 1), np.maximum(chars, 1)
    # Shares by their square root: small shares differ as much as large ones do.
    return np.stack([chars / words, np.sqrt(symbols / words), np.sqrt(stutter / words), np.sqrt(capitals / chars)], axis=1)


@dataclass(frozen=True)
class Forest:
    """Isolation trees as flat arrays: a node splits on ``feature`` at ``cut``, or is a leaf (feature -1)."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    norm: float
    threshold: float = math.inf

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score from 0 to 1: the shorter the mean path to isolation, the higher."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                inner = self.feature[at] >= 0
                if not inner.any():
                    break
                low = x[rows, np.maximum(self.feature[at], 0)] < self.cut[at]
                at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)
            total += self.path[at]
        return 2.0 ** (-total / len(self.roots) / self.norm)


def _mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n values."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """Trees over rows ``x`` that split at random within the box from ``low`` to ``high``.

    The box also spans values that no row of ``x`` has, so a split can part them from all rows: its side is then empty
    and the path ends there.
    """
    rng = np.random.default_rng(seed)
    nodes: list[list[float]] = []  # feature, cut, left, right, path
    size = min(tree_rows, len(x))
    limit = max(1, math.ceil(math.log2(max(2, size))))

    def node(rows: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + _mean_path(len(rows))])
        wide = np.flatnonzero(high > low)
        if depth < limit and len(rows) > 1 and wide.size:
            f = int(rng.choice(wide))
            cut = rng.uniform(low[f], high[f])
            below = rows[:, f] < cut
            top, bottom = high.copy(), low.copy()
            top[f] = bottom[f] = cut
            nodes[me][:4] = [f, cut, node(rows[below], low, top, depth + 1), node(rows[~below], bottom, high, depth + 1)]
        return me

    roots = [node(x[rng.choice(len(x), size, replace=False)], low, high, 0) for _ in range(trees)]
    table = np.array(nodes)
    whole = lambda k: table[:, k].astype(np.int64)
    return Forest(whole(0), table[:, 1], whole(2), whole(3), table[:, 4], np.array(roots), max(_mean_path(size), 1e-9))


def _score_column(stats: DataFrame, forest: Forest, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``stats`` and the forest's score."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS], axis=1)
            arrays = [batch.column(c) for c in keep]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(forest.scores(_features(counts)))], [*keep, "score"])

        return work

    kinds = dict(stats.dtypes)
    return map_rows(stats, make, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", score double")


def base_failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words"):
    return (F.col(n_words) < MIN_WORDS) | (100 * F.col(n_repeat_words) > MAX_REPEAT_PERCENT * F.col(n_words))


def fit(
    stats: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    max_good_rejected: float = MAX_GOOD_REJECTED,
) -> Forest | None:
    """Forest and threshold from the statistics of labelled documents; None without rows labelled good.

    The forest is grown on the good ones among at most ``sample_rows`` labelled rows that pass the base rules (least hash of
    doc_id first); the others widen the box it splits.
    The threshold counts all labelled rows in ``_BINS`` score bins, which is all that reaches the driver. A document
    labelled twice counts with its lower label; rows with a NULL label or doc_id do not count.
    """
    tables = Tables(stats.sparkSession)
    marks = labels.filter("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality")
    )
    marked = tables.write(stats.filter(~base_failed()).join(marks, "doc_id"), "marked")
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(sample_rows).select(*COUNTS, "quality").collect()
    rows = np.array([tuple(r) for r in sample], np.int64).reshape(-1, len(COUNTS) + 1)
    x, is_good = _features(rows[:, :-1]), rows[:, -1] > 0
    if not is_good.any():
        return None
    forest = grow(x[is_good], x.min(axis=0), x.max(axis=0))
    bins = (
        _score_column(marked, forest, ["quality"])
        .groupBy(F.floor(F.col("score") * _BINS).cast("int").alias("bin"), (F.col("quality") > 0).alias("good"))
        .count()
        .collect()
    )
    good, bad = np.zeros(_BINS + 2), np.zeros(_BINS + 2)
    for r in bins:
        (good if r["good"] else bad)[r["bin"]] += r["count"]
    above = lambda n: np.cumsum(n[::-1])[::-1]  # noqa: E731  rows in this bin or a higher one
    allowed = above(good) <= max_good_rejected * good.sum()
    caught = np.where(allowed, above(bad), -1)
    best = int(len(caught) - 1 - np.argmax(caught[::-1]))  # the highest threshold that catches as many
    tables.drop(marked)
    return Forest(**{**forest.__dict__, "threshold": best / _BINS if caught[best] > 0 else math.inf})


def judged(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """``stats`` with score, base_failed and kept. Without a forest the base rules decide alone."""
    names = stats.columns
    if forest is None:
        scored = stats.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = _score_column(stats, forest, names)
    normal = F.lit(True) if forest is None or math.isinf(forest.threshold) else F.col("score") < forest.threshold
    return scored.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & normal)


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Verdict for every row of ``docs``: (doc_id, counts, score, base_failed, kept).

    base_failed: under 20 words, or over 30 % of the words inside repeated 8-word windows. kept: neither base_failed nor
    anomalous. NULL and blank texts have zero counts and fail. Repeated rows and doc_ids are judged row by row; other
    columns are ignored. Without labels only the base rules decide; no rows give no rows.
    """
    tables = Tables(docs.sparkSession)
    stats = tables.write(with_statistics(docs), "statistics")
    return judged(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the rules keep, with the columns they came with. Edge cases as in ``assess``.

    The last pass counts and judges each text where it is read, so texts are not shuffled.
    """
    tables = Tables(docs.sparkSession)
    stats = tables.write(with_statistics(docs), "statistics")
    forest = fit(stats, labels)
    tables.drop(stats)
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                counts = np.array([statistics(t) for t in batch.column(at).cast(pa.string()).to_pylist()], np.int64)
                words, repeat = counts[:, COUNTS.index("n_words")], counts[:, COUNTS.index("n_repeat_words")]
                kept = (words >= MIN_WORDS) & (100 * repeat <= MAX_REPEAT_PERCENT * words)
                if forest is not None:
                    kept &= forest.scores(_features(counts)) < forest.threshold
                yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, schema)
