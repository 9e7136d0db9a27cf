"""Row filters and valid/invalid splits. All are narrow: no shuffle, one pass; only whole groups are judged after a first one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import is_blank
from tierline.scratch import staged

# Text accepted for a date, a decimal and an integer.
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"
DECIMAL_TEXT = r"^-?\d+(\.\d+)?$"
INTEGER_TEXT = r"^-?\d+$"


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def is_empty_row(columns: Sequence[str]) -> Column:
    """Every column NULL or the empty string."""
    filled = [F.when(F.col(c).cast("string") != "", True) for c in columns]
    return F.coalesce(*filled).isNull()


def filter_empty_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    return df.filter(~is_empty_row([c for c in df.columns if c not in ignore]))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(all_of([F.col(c).isNotNull() for c in columns]))


def null_measures(df: DataFrame, *measures: str) -> DataFrame:
    return df.filter(any_of([F.col(c).isNull() for c in measures]))


def with_indicator(df: DataFrame, indicator: str, column: str = "forecast_or_actual_ind") -> DataFrame:
    return df.filter(F.col(column) == indicator)


def last_days(df: DataFrame, column: str, days: int, run_date: str) -> DataFrame:
    """Rows of the ``days`` days up to ``run_date``; a literal bound, so partitions are pruned."""
    today = F.lit(run_date).cast("date")
    return df.filter((F.col(column) >= F.date_sub(today, days)) & (F.col(column) <= today))


def _written_as(kind: str) -> str:
    if kind == "date":
        return DATE_TEXT
    return DECIMAL_TEXT if kind.startswith("decimal") else INTEGER_TEXT


def misfit(name: str, kind: str) -> Column:
    """A filled text that is not written like its type, or is and does not fit it: no such day, too many digits."""
    value = F.col(name)
    wrong = ~value.rlike(_written_as(kind)) | value.try_cast(kind).isNull()
    return F.coalesce((value != "") & wrong, F.lit(False))


def type_violation(columns: Sequence[str], types: Mapping[str, str]) -> Column:
    """A filled text column that the cast to its type would turn into NULL, or that is written otherwise."""
    return any_of([misfit(c, kind) for c, kind in types.items() if c in columns])


def type_reasons(columns: Sequence[str], types: Mapping[str, str]) -> Column:
    """Names of the columns that break :func:`type_violation`, joined by commas; empty for a valid row."""
    return F.concat_ws(",", *[F.when(misfit(c, kind), c) for c, kind in types.items() if c in columns])


def required_violation(columns: Sequence[str], required: Sequence[str], source_columns: str | None = None) -> Column:
    """A required value is missing. When the source lacks one of the columns altogether, nothing is.

    ``source_columns`` names a column that lists, between bars, the columns of the file each row came from; so a row is
    judged alike whichever other files share its batch. Without it the frame's own columns count.
    """
    if source_columns in columns:
        offered = all_of([F.contains(F.col(source_columns), F.lit(f"|{c}|")) for c in required])
        missing = any_of([is_blank(F.col(c)) if c in columns else F.lit(True) for c in required])
        return F.coalesce(offered, F.lit(False)) & missing
    if not set(required) <= set(columns):
        return F.lit(False)
    return any_of([is_blank(F.col(c)) for c in required])


def split(df: DataFrame, violation: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): complementary filters over the same plan."""
    return df.filter(~violation), df.filter(violation)


def split_by_type(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    return split(df, type_violation(df.columns, types))


def split_by_required(
    df: DataFrame, required: Sequence[str], source_columns: str | None = None
) -> tuple[DataFrame, DataFrame]:
    return split(df, required_violation(df.columns, required, source_columns))


def split_whole(df: DataFrame, violation: Column, group: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by whole groups, such as files: one bad row holds back all rows of its group.

    Groups with a bad row are few, and found by one pass with a map-side distinct; both sides then read the frame again, so
    pass a stored one. The groups are written, so that their true size lets the rows stay where they are. Rows without a group
    are judged on their own.
    """
    bad = staged(df.filter(violation & F.col(group).isNotNull()).select(group).distinct(), "bad_groups")
    invalid = df.join(bad, group, "left_semi").unionByName(df.filter(violation & F.col(group).isNull()))
    alone = F.col(group).isNull() & F.coalesce(violation, F.lit(False))
    return df.filter(~alone).join(bad, group, "left_anti").select(*df.columns), invalid.select(*df.columns)


def unreadable(columns: Mapping[str, str], types: Mapping[str, str]) -> Column:
    """Names of the filled text columns that the cast to their type would turn into NULL; empty for a readable row.

    ``columns`` maps column names to their present types; what is no text is typed already.
    """
    told = [
        F.when((F.trim(c) != "") & F.trim(c).try_cast(kind).isNull(), c)
        for c, kind in types.items()
        if kind != "string" and columns.get(c) == "string"
    ]
    return F.concat_ws(",", *told)


def split_stats(df: DataFrame, violation: Column) -> DataFrame:
    """Both counts and their percentages in one aggregate."""
    counted = df.agg(F.count_if(~violation).alias("valid_rows"), F.count_if(violation).alias("invalid_rows"))
    total = F.col("valid_rows") + F.col("invalid_rows")

    def share(c: str) -> Column:
        return F.coalesce(F.try_divide(F.col(c) * F.lit(100).cast("decimal(5,0)"), total), F.lit(0)).cast(
            "decimal(5,1)"
        )

    return counted.select(
        "valid_rows", "invalid_rows", share("valid_rows").alias("valid_pct"), share("invalid_rows").alias("invalid_pct")
    )


def sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """A preview: the first ``n`` rows by their shown columns, so it is the same each time. Each task keeps ``n`` at most."""
    shown = df.select(*columns) if columns else df
    return shown.orderBy(*shown.columns).limit(n)
