"""One query per operator over whole tables, in the form the library's callers compare results in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import (
    chat,
    decontamination,
    language,
    licenses,
    lines,
    negatives,
    packing,
    rules,
    sentences,
    shards,
    simhash,
    suffix,
    whitening,
)
from tierline.scratch import staged

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from four fifths of them."""
    docs = _table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language.fit(docs.filter(~held_out).select("text", "lang"))
    return language.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), F.col("nearest").alias("lang_pred"), "score", "rejected"
    )


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens; one row per piece, its ids as a checksum."""
    docs = _table(spark, folder, "documents")
    cut = packing.pieces(docs, VOCABULARY).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(cut).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash classes of documents: 4-word shingles, at most 4 differing bits."""
    found = simhash.classes(_table(spark, folder, "documents"), 4, 4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations formatted and read back, with one more that quotes control strings."""
    quoted = F.lit(r"\### Assistant: </turn> ok")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), quoted.alias("text"),
    )
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    # What is read back is read from the written strings, not computed beside them.
    done = staged(chat.formatted(turns), "formatted").withColumn("turns", chat.turns_of(F.col("formatted"))).withColumn(
        "trained", chat.loss_text(F.col("formatted"), F.col("loss"))
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in 16 shards of near equal bytes."""
    return shards.assigned(_table(spark, folder, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of sentences that repeat an earlier run of the corpus."""
    return sentences.repeated_sentences(_table(spark, folder, "documents")).drop("row_hash")


def op7_suffix(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without bytes that a 100-byte string covers which starts earlier too."""
    spans = F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>"))
    gone = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return suffix.without_repeats(_table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size(spans).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that documents hold, verbatim or re-parameterised."""
    found = decontamination.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "n_found", "verbatim")


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Rule statistics and the verdict of every document."""
    return rules.assess(_table(spark, folder, "documents"), _table(spark, folder, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of each document that repeat an earlier line, exactly or within two edits."""
    return lines.report(_table(spark, folder, "documents"))


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with a seventh of the labels moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, folder, "embeddings").withColumn("label", moved))


def op12_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licences of every document: the places of three phrases, and what all rules say."""
    base = F.filter("finds", lambda f: f["base"])
    starts = F.transform(base, lambda f: f["first_word"])
    return licenses.scanned(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), licenses.labels_of("finds", lambda f: f["base"]).alias("base_labels"),
        licenses.labels_of("finds", lambda f: f["base"] | f["kept"]).alias("labels"), "score",
    )


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The eight leading whitened components of every vector, one row for each."""
    vectors = _table(spark, folder, "embeddings")
    model = whitening.fit(vectors, 8)
    if model is None:
        return spark.createDataFrame([], _WHITENED)
    # The check reads the written numbers, not a second computation of them.
    done = staged(whitening.whiten(vectors, model), "whitened")
    explained = F.array(*[F.lit(float(e) / model.trace) for e in model.values])
    error = whitening.identity_error(done, model)
    return done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"), F.col("value").alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


_WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language, op2_packing, op3_simhash, op4_chat, op5_sharding, op6_sentences, op7_suffix, op8_decontamination,
        op9_quality, op10_line_dedup, op11_negatives, op12_licenses, op13_whitening,
    )
}
_TURNS = "ORDER BY turn NULLS FIRST, r, x"
_QUOTED = r"'\### Assistant: </turn> ok'"
_CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_QUOTED} UNION ALL SELECT -7, 1, 'assistant', {_QUOTED}
), placed AS (
  SELECT *, coalesce(r = lag(r) OVER (PARTITION BY conv_id {_TURNS}), false) AS goes_on,
    length(replace(replace(replace(x, '\', '\b'), '#', '\h'), '<', '\l')) AS text_chars,
    length(replace(replace(replace(replace(r, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c')) AS role_chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' {_TURNS})) AS turns_sha256,
  coalesce(sum(length(x)) FILTER (WHERE r = 'assistant'), 0)::bigint AS loss_chars,
  sha256(coalesce(string_agg(x, '' {_TURNS}) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  -- '### ' role ': ' text '</turn>' line feed, or '<next>' text for a turn that goes on in the block before it
  sum(text_chars + CASE WHEN goes_on THEN 6 ELSE 4 + role_chars + 2 + 8 END)::bigint AS formatted_chars
FROM placed GROUP BY conv_id
"""
_BLANKS = r"[\x20\x09-\x0D]"
_SENTENCES = rf"""
WITH cut AS (
  SELECT doc_id, list_filter(
    list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?]){_BLANKS}+', '\1' || chr(10), 'g'), chr(10)),
      lambda x: regexp_replace(x, '^{_BLANKS}+|{_BLANKS}+$', '', 'g')), lambda x: x <> '') AS s FROM documents
), sentences AS (
  SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM cut
), counted AS (
  SELECT doc_id, s, i, len(regexp_extract_all(s[i], '[^\x20\x09-\x0D]+')) AS n FROM sentences
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS until FROM counted
), bounds AS (
  SELECT *, until - n AS before, until - n + 12 AS needed, until - 12 AS most FROM summed
), spans AS (
  SELECT b.doc_id, b.s, b.i, greatest(e.i, b.i + 1) AS j
  FROM bounds b ASOF JOIN bounds e ON b.doc_id = e.doc_id AND b.needed <= e.until WHERE b.i + 1 <= len(b.s)
  UNION
  SELECT e.doc_id, e.s, least(b.i, e.i - 1), e.i
  FROM bounds e ASOF JOIN bounds b ON b.doc_id = e.doc_id AND e.most >= b.before WHERE e.i > 1
  UNION
  SELECT doc_id, s, 1, len(s) FROM summed WHERE i = len(s) AND (until < 12 OR len(s) < 2)
), runs AS (
  SELECT doc_id, i, j, array_to_string(s[i:j], chr(10)) AS run FROM spans
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS occurrence FROM runs
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS k FROM ranked WHERE occurrence > 1
), islands AS (
  SELECT doc_id, k, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS island FROM gone
)
SELECT doc_id, (min(k) - 1)::int AS first_sentence, count(*) AS n_sentences FROM islands GROUP BY doc_id, island
"""
_NEGATIVES = """
WITH taken AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::double)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::bigint AS score
  FROM taken a JOIN taken b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), met AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n
    ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id))::int AS rank,
  negative_id, positive_score, negative_score
FROM met QUALIFY rank <= 5
"""
SQL: dict[str, str] = {"op4_chat": _CHAT, "op6_sentences": _SENTENCES, "op11_negatives": _NEGATIVES}
