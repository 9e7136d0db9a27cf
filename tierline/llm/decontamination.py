"""Benchmark decontamination by template windows, with DataFrame functions only.

Texts are brought to templates: numbers, runs of capitalised names and units become typed placeholders, everything else
is lower-cased without punctuation. Windows of template words, and of plain lower-cased words, of documents and benchmark
items are joined by hash. Along one alignment of a document with an item, the words behind the placeholders must map one
to one: a re-parameterised question replaces a value everywhere by the same other value; a chance match of templates does
not. Windows of other words where they do not are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import Tables, row_hash

#: Words of a window, and the share of an item's windows or words that must be found.
WINDOW, MIN_SHARE = 8, 0.5
#: One word of this many in a template window is no placeholder: eight numbers alone are no sign of an item.
LITERAL = 3
#: Alignments that this many words or fewer part from the next belong together: an item with words put in or left out.
SLACK = 16
#: Benchmark windows up to this many (under 100 MB with their keys) are broadcast; more are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000

# Placeholders: characters that no text has left after clean-up. MORE stands for further names of a run.
NUMBER, NAME, UNIT, MORE = "\u0001", "\u0002", "\u0003", "\u0004"
#: Words that are units after a number.
UNITS = (
    "mm cm m km in ft yd mi g kg mg lb oz t l ml s ms min h hr hrs sec secs second seconds minute minutes hour hours day days "
    "week weeks month months year years meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram "
    "grams kilogram kilograms pound pounds ounce ounces liter liters litre litres dollar dollars cent cents euro euros usd eur "
    "gbp mph kmh percent degree degrees c f k w kw v a hz khz mhz ghz kb mb gb tb"
).split()


def _clean(text: Column) -> Column:
    """Words parted by one space; of the punctuation only points and commas inside numbers remain."""
    parting = r"[^a-zA-Z0-9\p{L}\p{M}\p{N}](?:(?<![.,])|(?<![0-9].)|(?![0-9]))"
    more = r"(?:[^a-zA-Z0-9.,\p{L}\p{M}\p{N}]|[.,](?![0-9])|(?<![0-9])[.,])*+"
    return F.trim(F.regexp_replace(text, parting + more, " "))


def _template(clean: Column) -> Column:
    """Word by word the template of a cleaned text; placeholders never join or part words."""
    numbers = F.regexp_replace(clean, r"[0-9]+(?:[.,][0-9]+)*", NUMBER)
    names = F.regexp_replace(numbers, r"\p{Lu}(?<![\p{L}\p{M}]\p{Lu})[\p{Ll}\p{M}]++(?!\p{L})", NAME)
    runs = F.regexp_replace(names, f"(?<={NAME}) {NAME}(?= |$)", f" {MORE}")
    return F.regexp_replace(F.lower(runs), rf"{NUMBER}( ?)(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{M}}\p{{N}}])", f"{NUMBER}$1{UNIT}")


def _split(column: Column) -> Column:
    """Words of a cleaned text; none of a NULL or empty one."""
    return F.when(column != "", F.split(column, " ", -1)).otherwise(F.array().cast("array<string>"))


def _placeholder(token: Column) -> Column:
    return token.rlike(f"[{NUMBER}{NAME}{UNIT}]")


def _worded(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``words``, lower-cased; ``tokens``, the template with runs of names as one; ``places``, their words."""
    return (
        df.withColumn("clean", _clean(text.cast("string")))
        .withColumn("words", _split(F.lower("clean")))
        .withColumn("marked", _split(_template(F.col("clean"))))
        .withColumn("tokens", F.filter("marked", lambda w: w != MORE))
        .withColumn("places", F.filter(F.transform("marked", lambda w, i: F.when(w != MORE, i)), lambda i: i.isNotNull()))
        .drop("clean", "marked")
    )


def _hashed(df: DataFrame, sizes: list[int]) -> DataFrame:
    """``df`` with ``plain<size>`` and ``template<size>``: a hash for every window of ``words`` and of ``tokens``.

    Windows are made from windows of half the size, so a word costs a few hashes of two numbers whatever the size.
    """
    df = df.withColumn("plain1", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("template1", F.transform("tokens", lambda w: F.xxhash64(w)))
    powers = [1 << k for k in range(max(sizes).bit_length())]

    def joined(first: str, second: str, held: int) -> Column:
        n = F.greatest(F.size(second) - held, F.lit(0))
        return F.zip_with(F.slice(first, 1, n), F.slice(second, held + 1, n), lambda a, b: F.xxhash64(a, b))

    for name in ("plain", "template"):
        for half, whole in zip(powers, powers[1:], strict=False):
            df = df.withColumn(f"{name}{whole}", joined(f"{name}{half}", f"{name}{half}", half))
        for size in sizes:
            held = 0
            for power in (p for p in reversed(powers) if size & p):
                if held and held + power not in powers:
                    df = df.withColumn(f"{name}{held + power}", joined(f"{name}{held}", f"{name}{power}", held))
                held += power
    return df


def _windows(df: DataFrame, keys: list[str], sizes: list[int]) -> DataFrame:
    """(keys, of, plain, no, at, h): windows of ``of`` words (``plain``) or tokens; ``no`` counts words or tokens, ``at`` is
    the word where it starts."""

    def zipped(size: int) -> Column:
        return F.arrays_zip(
            F.col(f"plain{size}").alias("p"), F.col(f"template{size}").alias("t"),
            F.slice("places", 1, F.size(f"template{size}")).alias("at"),
        )

    hashed = _hashed(df, sizes)
    if len(sizes) == 1:
        placed = hashed.select(*keys, F.lit(sizes[0]).alias("of"), F.posexplode(zipped(sizes[0])).alias("no", "w"))
    else:
        every = F.array(*[F.struct(F.lit(s).alias("of"), zipped(s).alias("zipped")) for s in sizes])
        placed = hashed.select(*keys, F.inline(every)).select(*keys, "of", F.posexplode("zipped").alias("no", "w"))
    both = F.array("w.p", "w.t")
    found = placed.select(*keys, "of", "no", F.col("w.at").alias("place"), F.posexplode(both).alias("kind", "h"))
    plain = F.col("kind") == 0
    return found.filter("h IS NOT NULL").select(
        *keys, "of", plain.alias("plain"), "no", F.when(plain, F.col("no")).otherwise(F.col("place")).alias("at"), "h"
    )


def _items(benchmark: DataFrame, window: int) -> DataFrame:
    """Items with a word, equal ones once: (item, item_id, words, tokens, places, size, token_size)."""
    worded = _worded(benchmark.select(row_hash(["item_id", "text"]).alias("item"), "item_id", "text"), F.col("text")).drop("text")
    sized = worded.filter(F.size("words") > 0).dropDuplicates(["item"])
    return sized.withColumn("size", F.least(F.size("words"), F.lit(window))).withColumn(
        "token_size", F.least(F.size("tokens"), F.lit(window))
    )


def item_windows(items: DataFrame, sizes: list[int]) -> DataFrame:
    """(item, item_id, n, size, token_size, plain, no, first, last, h): an item shorter than a window is one window of its
    own size. ``first`` to ``last`` are the starts of the windows of ``size`` words that a window covers.

    Template windows without placeholders are left out, since their words are a plain window, and so are those with
    fewer literal words than one in ``LITERAL``; windows of documents then meet neither.
    """
    keys = ["item", "item_id", "n", "size", "token_size", "places", "tokens"]
    found = _windows(items.withColumn("n", F.size("words")), keys, sizes)
    own = F.when(F.col("plain"), F.col("size")).otherwise(F.col("token_size"))
    behind = F.coalesce(F.get("places", F.col("no") + F.col("token_size")), F.col("n"))
    last = F.when(F.col("plain"), F.col("at")).otherwise(behind - F.col("size"))
    held = F.size(F.filter(F.slice("tokens", F.col("no") + 1, F.col("of")), _placeholder))
    told = (held > 0) & (held <= F.col("of") - F.floor((F.col("of") + LITERAL - 1) / LITERAL))
    return found.filter((F.col("of") == own) & (F.col("plain") | told)).select(
        *keys[:-2], "plain", "no", F.col("at").alias("first"), last.alias("last"), "h"
    )


def _alignments(docs: DataFrame, items: DataFrame, sizes: list[int]) -> DataFrame:
    """One row for every alignment of a document with an item: (row_hash, doc_id, item, item_id, n, size, token_size, plain,
    diagonal, shift, found); ``found`` holds the item's windows, at most all of them."""
    keyed = docs.select(row_hash(docs.columns).alias("row_hash"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    windows = _windows(_worded(keyed, F.col("text")), ["row_hash", "doc_id"], sizes)
    side = items if items.count() > BROADCAST_WINDOWS else F.broadcast(items)
    rows = windows.select("row_hash", "doc_id", F.col("no").alias("doc_no"), "at", "h")
    hits = rows.join(side, "h")
    keys = ["row_hash", "doc_id", "item", "item_id", "n", "size", "token_size", "plain"]
    return hits.groupBy(*keys, (F.col("doc_no") - F.col("no")).alias("diagonal")).agg(
        F.min(F.col("at") - F.col("first")).alias("shift"), F.collect_set(F.struct("no", "first", "last")).alias("found")
    )


def _in_reach(alignments: DataFrame, min_share: float) -> DataFrame:
    """Alignments with ``reach``, the number of their set of neighbouring alignments within document and item; sets that
    cannot hold enough windows are left out."""
    by_shift = Window.partitionBy("row_hash", "item").orderBy("shift")
    far = F.col("shift") - F.lag("shift").over(by_shift) > SLACK
    marked = alignments.withColumn("far", F.coalesce(far.cast("int"), F.lit(0)))
    reached = marked.withColumn("reach", F.sum("far").over(by_shift.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    most = F.aggregate("found", F.lit(0).cast("long"), lambda s, f: s + f["last"] - f["first"] + 1)
    held = F.sum(most).over(Window.partitionBy("row_hash", "item", "reach"))
    return reached.withColumn("held", held).filter(F.col("held") * F.col("size") >= min_share * F.col("n")).drop("far", "held")


def _clashes(templates: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row_hash, item, diagonal, clashing): tokens of the item whose placeholder does not map one to one."""
    keys = ["row_hash", "item", "diagonal"]
    marked = docs.select(row_hash(docs.columns).alias("row_hash"), "text").join(
        templates.select("row_hash").distinct(), "row_hash", "left_semi"
    )
    doc_side = _worded(marked.dropDuplicates(["row_hash"]), F.col("text")).select(
        "row_hash", F.col("words").alias("doc_words"), F.col("places").alias("doc_places")
    )
    joined = templates.join(doc_side, "row_hash").join(items.select("item", "words", "tokens", "places"), "item")

    def behind(words: str, places: str, no: Column) -> Column:
        start = F.get(places, no)
        end = F.coalesce(F.get(places, no + 1), F.size(words))
        return F.xxhash64(F.slice(words, start + 1, end - start))

    under = F.array_distinct(F.flatten(F.transform("found", lambda f: F.sequence(f["no"], f["no"] + F.col("token_size") - 1))))
    held = F.filter(under, lambda p: _placeholder(F.get("tokens", p)))
    slot = lambda p: F.struct(
        p.alias("p"), F.get("tokens", p).alias("type"), behind("words", "places", p).alias("a"),
        behind("doc_words", "doc_places", p + F.col("diagonal")).alias("b"),
    )
    slots = joined.select(*keys, F.inline(F.transform(held, slot)))
    left, right = Window.partitionBy(*keys, "type", "a"), Window.partitionBy(*keys, "type", "b")
    odd = (F.min("b").over(left) != F.max("b").over(left)) | (F.min("a").over(right) != F.max("a").over(right))
    return slots.withColumn("odd", odd).filter("odd").groupBy(*keys).agg(F.collect_set("p").alias("clashing"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = MIN_SHARE, tables: Tables | None = None
) -> DataFrame:
    """Benchmark items found in documents: (row_hash, doc_id, item_id, n_windows, n_found, share, verbatim).

    A window is found where its words stand in any case, or its template, with a literal word in three, and words behind the
    placeholders that map one to one between item and document, over the template windows of one alignment; a run of
    names is one placeholder. Tables of numbers and lists of names are found by their words only. A document holds an
    item if at least ``min_share`` of the item's windows are found in neighbouring alignments, or windows that cover as
    much of its words, words under a window that maps otherwise left out. ``verbatim`` tells that all windows found are of the same words. The best set of alignments counts.
    An item of fewer words than a window is one window, found whole or not at all.

    NULL and wordless texts and items match nothing. Items equal in id and text count once, items of one id and other texts
    as one each; rows equal in every column count as one document. Other columns only tell rows apart. No documents or
    no items give no rows.
    """
    tables = tables or Tables(docs.sparkSession)
    items = tables.write(_items(benchmark, window), "items")
    per_item = items.select(F.explode(F.array("size", "token_size")).alias("size")).distinct()
    sizes = sorted(r["size"] for r in per_item.collect())  # at most ``window`` numbers
    if not sizes:
        return docs.sparkSession.createDataFrame(
            [], "row_hash long, doc_id long, item_id long, n_windows int, n_found long, share double, verbatim boolean"
        )
    rows = tables.write(item_windows(items, sizes), "item_windows")
    alignments = tables.write(_alignments(docs, rows, sizes), "alignments")
    aligned = tables.write(_in_reach(alignments, min_share), "aligned")
    templates = aligned.filter("NOT plain")
    clashes = _clashes(templates, docs, items)
    around = lambda f: F.sequence(f["no"], f["no"] + F.col("token_size") - 1)
    clash = lambda f: F.coalesce(F.arrays_overlap(around(f), "clashing"), F.lit(False))
    judge = F.transform("found", lambda f: f.withField("fit", ~clash(f)))
    keys = ["row_hash", "doc_id", "item", "item_id", "n", "size", "reach"]
    mapped = templates.join(clashes, ["row_hash", "item", "diagonal"], "left").select(*keys, "shift", "plain", F.inline(judge))
    same = aligned.filter("plain").select(*keys, "shift", "plain", F.inline("found")).withColumn("fit", F.lit(True))
    starts = same.unionByName(mapped).select(*keys, "shift", "plain", "fit", F.explode(F.sequence("first", "last")).alias("at"))
    placed = starts.groupBy(*keys, "shift", "at").agg(F.max("plain").alias("plain"), F.max("fit").alias("fit"))
    # In one place of a document at most all windows of an item are collected.
    sides = placed.groupBy(*keys, "shift").agg(
        F.collect_list(F.when(F.col("fit"), F.struct("at", "plain"))).alias("fit"),
        F.collect_list(F.when(~F.col("fit"), F.col("at"))).alias("unfit"),
    )
    words = lambda a: F.array_distinct(F.flatten(F.transform(a, lambda x: F.sequence(x, x + F.col("size") - 1))))
    covered = F.array_except(words(F.transform("fit", lambda f: f["at"])), words(F.col("unfit")))
    word = lambda x: F.struct(F.lit(True).alias("word"), x.alias("at"), F.lit(False).alias("plain"))
    start = lambda f: F.struct(F.lit(False).alias("word"), f["at"].alias("at"), f["plain"].alias("plain"))
    marks = sides.select(*keys, F.inline(F.concat(F.transform("fit", start), F.transform(covered, word))))
    sets = marks.groupBy(*keys, "word", "at").agg(F.max("plain").alias("plain")).groupBy(*keys).agg(
        F.count_if(~F.col("word")).alias("n_found"), F.count_if("plain").alias("n_plain"), F.count_if("word").alias("n_covered")
    )
    windows = F.col("n") - F.col("size") + 1
    judged = sets.filter((F.col("n_found") >= min_share * windows) | (F.col("n_covered") >= min_share * F.col("n")))
    best = judged.groupBy("row_hash", "doc_id", "item", "item_id", windows.alias("n_windows")).agg(
        F.max(F.struct("n_found", (F.col("n_plain") == F.col("n_found")).alias("verbatim"))).alias("best")
    )
    return best.select(
        "row_hash", "doc_id", "item_id", "n_windows", "best.n_found",
        (F.col("best.n_found") / F.col("n_windows")).alias("share"), "best.verbatim",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents that hold no benchmark item; columns and their order stay. Edge cases as in ``contaminated``."""
    tables = Tables(docs.sparkSession)
    mark = "row_hash_of_document"
    gone = contaminated(docs, benchmark, tables=tables, **options).select(F.col("row_hash").alias(mark)).distinct()
    gone = tables.write(gone, "gone")
    return docs.withColumn(mark, row_hash(docs.columns)).join(gone, mark, "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
