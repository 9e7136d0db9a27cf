"""Chat formatting as Spark expressions: turns to one training string with a loss mask, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template: a block of one role opens with HEAD, the role and COLON, its turns are parted by NEXT, and
#: it ends with END. None can occur in an escaped text, which has neither of the characters # and <.
HEAD, COLON, NEXT, END = "### ", ": ", "<next>", "</turn>\n"
#: The role whose texts are trained on.
TRAINED = "assistant"
_CODES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))


def escaped(text: Column, role: bool = False) -> Column:
    """Control characters as a backslash and a letter; roles lose their colons too."""
    for sign, code in _CODES if role else _CODES[:-1]:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """Undo ``escaped``: the backslash's own code last, so that what it leaves isn't read as a code."""
    for sign, code in reversed(_CODES):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def formatted(conversations: DataFrame) -> DataFrame:
    """One row per conversation: (conv_id, formatted, loss). ``loss`` are spans (start from 0, length) in code points.

    A conversation's turns are collected as structs and sorted by turn, role and text; neighbours of one role merge into a
    block. NULL texts and roles are empty ones, a NULL turn comes first, NULL conv_ids are one conversation, and repeated
    rows are turns of their own. Other columns are ignored; no rows give no rows. A conversation is one output row, so
    its turns meet in one task; that is the only group made.
    """
    turn = F.struct(
        "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    collected = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    none = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def block(t: Column, texts: Column) -> Column:
        return F.array(F.struct(t["role"].alias("role"), texts.alias("texts")))

    def merge(blocks: Column, t: Column) -> Column:
        last = F.get(blocks, F.size(blocks) - 1)
        text = F.array(escaped(t["text"]))
        return F.when(
            (F.size(blocks) > 0) & (last["role"] == t["role"]),
            F.concat(F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0))), block(t, F.concat(last["texts"], text))),
        ).otherwise(F.concat(blocks, block(t, text)))

    merged = collected.select("conv_id", F.aggregate("turns", none, merge).alias("blocks"))

    def head(b: Column) -> Column:
        return F.concat(F.lit(HEAD), escaped(b["role"], role=True), F.lit(COLON))

    text = F.array_join(
        F.transform("blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], NEXT), F.lit(END))), ""
    )
    # Walk over the blocks with the position reached and the spans found.
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def inside(state: Column, b: Column) -> Column:
        begun = F.struct((state["at"] + F.length(head(b))).alias("at"), state["spans"].alias("spans"))
        walked = F.aggregate(
            b["texts"],
            begun,
            lambda s, x: F.struct(
                (s["at"] + F.length(x) + len(NEXT)).alias("at"),
                F.when(
                    b["role"] == TRAINED, F.concat(s["spans"], F.array(F.struct(s["at"].alias("start"), F.length(x).alias("length"))))
                ).otherwise(s["spans"]).alias("spans"),
            ),
        )
        return F.struct((walked["at"] - len(NEXT) + len(END)).alias("at"), walked["spans"].alias("spans"))

    return merged.select("conv_id", text.alias("formatted"), F.aggregate("blocks", start, inside)["spans"].alias("loss"))


def turns_of(text: Column) -> Column:
    """The turns (role, text) that a formatted string holds, read from the string alone."""
    blocks = F.filter(F.split(text, END), lambda b: b != "")

    def turns(b: Column) -> Column:
        rest = F.substring(b, F.lit(len(HEAD) + 1), F.length(b))
        role = F.substring_index(rest, COLON, 1)
        body = F.substring(rest, F.length(role) + len(COLON) + 1, F.length(rest))
        return F.transform(
            F.split(body, NEXT), lambda t: F.struct(unescaped(role).alias("role"), unescaped(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]))), "")
