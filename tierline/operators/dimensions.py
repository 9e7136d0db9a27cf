"""Dimension tables: one row per key, and insert-if-new maintenance."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions import (
    concat_key,
    describe_indicator,
    int_key,
    natural_key,
    normalized,
)
from tierline.model import Dimension
from tierline.operators.rows import not_null
from tierline.operators.shape import stamp


def dimension_members(bronze: DataFrame, dim: Dimension) -> DataFrame:
    """Distinct members of one dimension: (norm, label, attribute), reading only its one or two columns.

    Spellings are made distinct first. That is a plain hash aggregate with map-side combining, so a value
    that fills a third of the input costs no more than a rare one. Picking one spelling per key (the
    smallest, with a filled attribute if there is one) then sees distinct spellings only.
    """
    label = F.col(dim.natural)
    attribute = F.col(dim.attribute[0]) if dim.attribute else F.lit(None).cast("string")
    spellings = (
        bronze.filter(label.isNotNull()).select(label.alias("label"), attribute.alias("attribute")).distinct()
    )
    ranked = F.struct("label", F.col("attribute").isNull().alias("unfilled"), "attribute")
    return (
        spellings.groupBy(normalized(F.col("label")).alias("norm"))
        .agg(F.min(ranked).alias("m"))
        .select("norm", "m.label", "m.attribute")
    )


def all_members(bronze: DataFrame, dims: Iterable[Dimension]) -> DataFrame:
    """Members of several dimensions in one job: (dimension, norm, label, attribute).

    One narrow scan per dimension. Together they read each column once, and measured against a single scan
    that fans every row out to all dimensions they need a fraction of the work.
    """
    frames = [dimension_members(bronze, d).withColumn("dimension", F.lit(d.table)) for d in dims]
    return reduce(DataFrame.unionByName, frames).select("dimension", "norm", "label", "attribute")


def from_members(members: DataFrame, dim: Dimension) -> DataFrame:
    """Dimension columns from (norm, label, attribute) rows; hashes are computed once per member."""
    key = F.md5("norm").alias(dim.key)
    if dim.table == "dim_date":
        day = F.try_to_date("label", "yyyy-MM-dd")
        return members.select(
            key,
            day.alias("call_date"),
            # A date has one month, whatever its rows say; only an unreadable date keeps theirs.
            F.coalesce(F.date_format(day, "yyyy-MM"), F.col("attribute")).alias("call_month"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
        )
    columns = [key, F.col("label").alias(dim.label)]
    if dim.attribute_key:
        columns.append(natural_key(F.col("attribute")).alias(dim.attribute_key))
    if dim.attribute:
        columns.append(F.col("attribute").alias(dim.attribute[1]))
    return members.select(*columns)


def build_dimension(bronze: DataFrame, dim: Dimension) -> DataFrame:
    return from_members(dimension_members(bronze, dim), dim)


def new_members(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Candidates whose key the table does not hold yet: insert new, keep existing.

    An anti join; nothing is collected, and an error reading the table is an error.
    """
    return candidates.join(existing.select(key), key, "left_anti")


def filled_members(candidates: DataFrame, existing: DataFrame, key: str, attributes: Iterable[str]) -> DataFrame:
    """Stored members that lack an attribute which the candidates know, with the attribute filled in.

    Together with :func:`new_members` this makes the dimension independent of how rows fall into batches: a filled
    attribute is kept, an empty one takes the first value that comes.
    """
    names = list(attributes)
    if not names:
        return existing.limit(0)
    known = candidates.select(key, *[F.col(a).alias(f"__{a}") for a in names])
    lacking = reduce(lambda x, y: x | y, [F.col(a).isNull() & F.col(f"__{a}").isNotNull() for a in names])
    joined = existing.join(known, key).filter(lacking)
    return joined.withColumns({a: F.coalesce(a, f"__{a}") for a in names}).select(*existing.columns)


def forecast_actual_dimension(bronze: DataFrame) -> DataFrame:
    indicator = F.col("forecast_or_actual_ind")
    return (
        not_null(bronze, "forecast_or_actual_ind")
        .select(indicator)
        .distinct()
        .select(
            int_key(indicator).alias("forecast_actual_key"),
            indicator,
            describe_indicator(indicator).alias("forecast_actual_desc"),
        )
    )


def partner_dimension(bronze: DataFrame, run_at: str) -> DataFrame:
    name, group = F.col("partner_name"), F.col("partner_group_name")
    partners = not_null(bronze, "partner_name", "partner_group_name").select(name, group).distinct()
    columns = partners.select(
        int_key(name, group).alias("partner_id"),
        concat_key(name, group).alias("partner_key"),
        name,
        group,
        F.lit("").alias("partner_pmn"),
        F.lit("").alias("partner_country"),
        F.lit(True).alias("is_active"),
    )
    return stamp(columns, run_at)


def agreement_dimension(bronze: DataFrame, run_at: str) -> DataFrame:
    reference = F.col("agreement_reference")
    agreements = not_null(bronze, "agreement_reference").select(reference).distinct()
    columns = agreements.select(
        int_key(reference).alias("agreement_id"),
        reference.alias("agreement_key"),
        int_key(reference).alias("iot_agreement_id"),
        reference,
        F.lit("ACTIVE").alias("agreement_status"),
        F.lit(run_at).cast("timestamp").cast("date").alias("agreement_start_date"),
        F.lit(None).cast("date").alias("agreement_end_date"),
        F.lit("SDR").alias("currency"),
    )
    return stamp(columns, run_at)
