"""Deterministic surrogate keys.

Keys are pure functions of the natural value, so facts and dimensions can be built independently and in any
order, and re-running a load always yields the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text whose hash stands for a missing natural key.
UNKNOWN = "unknown"


def normalized(value: Column) -> Column:
    """The spelling-insensitive form of a natural key."""
    return F.lower(F.trim(value))


def normalized_or_unknown(value: Column) -> Column:
    return F.coalesce(normalized(value), F.lit(UNKNOWN))


def natural_key(value: Column) -> Column:
    """MD5 of the normalised value; NULL stays NULL."""
    return F.md5(normalized(value))


def key_or_unknown(value: Column) -> Column:
    """As :func:`natural_key`, with NULL mapped to the key of ``unknown``."""
    return F.md5(normalized_or_unknown(value))


def composite_hash(*values: Column, sep: str = "|") -> Column:
    """MD5 of the joined values. NULLs are skipped, so use it on non-NULL keys only."""
    return F.md5(F.concat_ws(sep, *values))


def spelled(*values: Column) -> Column:
    """The values in one text that only they give: each behind its length, NULL as ``-``."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def row_hash(*values: Column) -> Column:
    """Content hash of a row: no other values in these positions share its text, NULL and the empty string differ."""
    return F.md5(spelled(*values))


def int_key(*values: Column) -> Column:
    """60-bit integer key: the first 15 hex digits of the MD5, NULL when every value is NULL.

    A 32-bit hash would collide at about fifty thousand keys and give NULL a valid-looking id.
    """
    text = values[0].cast("string") if len(values) == 1 else spelled(*values)
    digits = F.substring(F.md5(text), 1, 15)
    key = F.conv(digits, 16, 10).cast("long")
    return F.when(F.coalesce(*[v.cast("string") for v in values]).isNotNull(), key)


def concat_key(*values: Column) -> Column:
    return F.concat_ws("_", *values)
