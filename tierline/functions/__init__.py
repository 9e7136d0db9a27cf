"""Column functions: every one maps Column(s) to a Column and stays inside whole-stage codegen."""

from tierline.functions.dates import (
    date_key,
    iso_date_text,
    parse_date,
    year_month,
)
from tierline.functions.keys import (
    composite_hash,
    concat_key,
    int_key,
    key_or_unknown,
    natural_key,
    normalized,
    normalized_or_unknown,
    row_hash,
)
from tierline.functions.numbers import clean_decimal, variance_pct
from tierline.functions.text import (
    blank_to_null,
    describe_indicator,
    is_blank,
    is_forecast,
    packed_texts,
    unpacked_texts,
)

__all__ = [
    "blank_to_null",
    "clean_decimal",
    "composite_hash",
    "concat_key",
    "date_key",
    "describe_indicator",
    "int_key",
    "is_blank",
    "is_forecast",
    "iso_date_text",
    "key_or_unknown",
    "natural_key",
    "normalized",
    "normalized_or_unknown",
    "packed_texts",
    "parse_date",
    "row_hash",
    "unpacked_texts",
    "variance_pct",
    "year_month",
]
