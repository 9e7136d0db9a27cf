"""Text predicates and indicator columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forecast/actual indicator.
FORECAST, ACTUAL = "F", "A"


def blank_to_null(value: Column) -> Column:
    return F.when(F.trim(value) != "", value)


def is_blank(value: Column) -> Column:
    """NULL, empty or spaces only."""
    return F.trim(F.coalesce(value, F.lit(""))) == ""


def is_forecast(indicator: Column) -> Column:
    return indicator == FORECAST


def describe_indicator(indicator: Column) -> Column:
    return (
        F.when(indicator == FORECAST, "Forecast")
        .when(indicator == ACTUAL, "Actual")
        .otherwise("Unknown")
    )


# What divides packed texts, and what marks either of the two inside a text.
DIVIDER, ESCAPE = "\x1f", "\x1e"


def packed_texts(*names: str) -> Column:
    """Columns of texts, none of them NULL, as one text that only they give; :func:`unpacked_texts` takes it apart."""

    def escaped(text: Column) -> Column:
        return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0")), F.lit(DIVIDER), F.lit(ESCAPE + "1"))

    whole = F.concat(*names)
    odd = F.contains(whole, F.lit(DIVIDER)) | F.contains(whole, F.lit(ESCAPE))
    return F.when(odd, F.array_join(F.transform(F.array(*names), escaped), DIVIDER)).otherwise(F.concat_ws(DIVIDER, *names))


def unpacked_texts(packed: Column) -> Column:
    """The texts, as an array."""

    def told(text: Column) -> Column:
        return F.replace(F.replace(text, F.lit(ESCAPE + "1"), F.lit(DIVIDER)), F.lit(ESCAPE + "0"), F.lit(ESCAPE))

    texts = F.split(packed, DIVIDER, -1)
    return F.when(F.contains(packed, F.lit(ESCAPE)), F.transform(texts, told)).otherwise(texts)
