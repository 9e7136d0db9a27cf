"""Usage records from landed text to monthly totals.

``clean_usage`` to ``usage_daily`` are plain frame-to-frame steps. ``load_usage`` runs them against stored
tables for one batch of files and touches only what that batch affects.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.model import (
    DIMENSION_TABLES,
    USAGE_ALIASES,
    USAGE_DIMENSIONS,
    USAGE_TYPES,
    Dimension,
    TableSpec,
    table_spec,
)
from tierline.operators import dimensions as dims
from tierline.operators import facts, increments, marts, tables, upserts
from tierline.operators.rows import filter_empty_rows, split, type_reasons, type_violation
from tierline.operators.shape import (
    add_audit_columns,
    cast_all_to_string,
    normalize_columns,
    normalize_dates,
    remap_columns,
    stamp,
)
from tierline.scratch import staged
from tierline.session import wide_rows
from tierline.sources.files import SOURCE, SOURCE_PATH, SOURCE_TEXT, tenant_of

BOUNDED = [d for d in USAGE_DIMENSIONS.values() if not d.unbounded]
UNBOUNDED = [d for d in USAGE_DIMENSIONS.values() if d.unbounded]
#: Days with so many partitions of partial sums get one set of files.
COMPACT_AT = 16
#: Dimensions that are updated at the same time.
AT_ONCE = 8


def clean_usage(raw: DataFrame) -> DataFrame:
    """Blank rows out, headers normalised and mapped, everything text, compact dates rewritten."""
    rows = filter_empty_rows(raw, ignore=SOURCE)
    named = remap_columns(normalize_columns(rows, keep=SOURCE), USAGE_ALIASES)
    return normalize_dates(cast_all_to_string(named), "call_date")


def usage_violation(columns: list[str]) -> Column:
    """A value that does not fit its type, or a row with more or fewer cells than its header."""
    broken = type_violation(columns, USAGE_TYPES)
    return broken | F.col(SOURCE_TEXT).isNotNull() if SOURCE_TEXT in columns else broken


def usage_reasons(columns: list[str]) -> Column:
    """What is wrong with a row: the columns that do not fit, or ``cells`` for a row that its header does not fit."""
    reasons = type_reasons(columns, USAGE_TYPES)
    if SOURCE_TEXT not in columns:
        return reasons
    return F.when(F.col(SOURCE_TEXT).isNotNull(), "cells").otherwise(reasons)


def split_usage(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by the types the text takes in silver."""
    return split(cleaned, usage_violation(cleaned.columns))


def usage_bronze(raw: DataFrame) -> DataFrame:
    return split_usage(clean_usage(raw))[0]


def staged_dimensions(bronze: DataFrame) -> dict[str, DataFrame]:
    """All dimensions as written tables, so the star join knows their true sizes.

    The bounded ones are written by one job; the subscriber dimension is built on its own.
    """
    members = staged(dims.all_members(bronze, BOUNDED), "members", partition_by="dimension")
    built = {d.table: dims.from_members(_members_of(members, d.table), d) for d in BOUNDED}
    for dim in UNBOUNDED:
        built[dim.table] = staged(dims.build_dimension(bronze, dim), dim.table)
    return built


def _members_of(members: DataFrame, table: str) -> DataFrame:
    return members.filter(F.col("dimension") == table)


def usage_daily(bronze: DataFrame, dimensions: Mapping[str, DataFrame] | None = None, *, placed: bool = False) -> DataFrame:
    """Daily rows of bronze rows; ``placed`` ones say that they lie by subscriber."""
    dimensions = dimensions or staged_dimensions(bronze)
    return marts.usage_daily(facts.usage_fact_by(bronze, UNBOUNDED[0]), dimensions, *(marts.PLACED if placed else ()))


def _call_day(call_date: Column) -> Column:
    """Partition value: the calendar day, or ``unknown``; never NULL, so it can prune partitions in a join."""
    return F.coalesce(F.date_format(F.try_to_date(call_date, "yyyy-MM-dd"), "yyyy-MM-dd"), F.lit("unknown"))


def usage_specs() -> list[TableSpec]:
    pairs = [
        ("traffic", "bronze"), ("traffic_increment", "silver"), ("traffic", "silver"),
        ("traffic", "gold"), ("traffic_state", "silver"), ("traffic_monthly", "gold"),
    ]
    return [table_spec(*p) for p in pairs] + [DIMENSION_TABLES[d] for d in USAGE_DIMENSIONS]


def create_usage_tables(spark: SparkSession, tenant: str) -> None:
    tables.create_schemas(spark, tenant)
    for spec in usage_specs():
        tables.create_from_spec(spark, tenant, spec)


def load_usage(
    spark: SparkSession, tenant: str, raw: DataFrame, batch: str, loaded_at: str, quarantine: str, compact_at: int = COMPACT_AT
) -> None:
    """One batch of raw rows (with their file path) through bronze, silver and gold.

    Every step replaces partitions or inserts missing keys, so a batch can be repeated after any failure, on another day,
    and with other rows than before: whatever the earlier run left is replaced, and the days that only it had are rebuilt
    without it. The work follows the batch: bronze is read for this batch only, and the fact, daily and monthly tables
    are rebuilt for the days and months it touches, from per-batch partial sums instead of from bronze. Days with
    ``compact_at`` partitions of partial sums and more have them merged.
    """
    create_usage_tables(spark, tenant)
    write_bronze(tenant, raw, batch, loaded_at, quarantine)
    batch_rows = accepted_rows(spark, tenant).filter(F.col("_batch") == batch)
    update_dimensions(spark, tenant, batch_rows, loaded_at)
    days, stale = write_increment(spark, tenant, batch_rows, batch)
    update_fact(spark, tenant, batch, days, stale, loaded_at)
    update_gold(spark, tenant, days, loaded_at)
    # Last, so that a run that stops before knows from them which days to rebuild.
    increment = table_spec("traffic_increment", "silver").full_name(tenant)
    increments.forget(spark, increment, batch, stale)
    increments.compact(spark, increment, days, compact_at)


def accepted_rows(spark: SparkSession, tenant: str) -> DataFrame:
    """Bronze rows that passed validation; the flag is a partition column, so rejected files are not read."""
    return spark.table(table_spec("traffic", "bronze").full_name(tenant)).filter("_accepted")


def write_bronze(tenant: str, raw: DataFrame, batch: str, loaded_at: str, quarantine: str) -> None:
    """Parse and clean the batch once: accepted and rejected rows go to partitions of their own.

    The quarantine files are then copied from the rejected partition, not parsed a second time.
    """
    path = F.col(SOURCE_PATH)
    cleaned = add_audit_columns(
        clean_usage(raw), path, tenant=tenant_of(path), layer="bronze", domain="traffic", ingested_at=loaded_at
    )
    judged = cleaned.withColumns({"_batch": F.lit(batch), "_accepted": ~usage_violation(cleaned.columns)})
    name = table_spec("traffic", "bronze").full_name(tenant)
    # The reason travels in the column that sources use for it.
    judged = judged.withColumn(
        "error_message",
        F.when(F.col("_accepted"), F.col("error_message") if "error_message" in judged.columns else F.lit(None)).otherwise(
            usage_reasons(cleaned.columns)
        ),
    )
    with wide_rows(raw.sparkSession):
        tables.replace_batch(judged, name, batch)
    rejected = raw.sparkSession.table(name).filter((F.col("_batch") == batch) & ~F.col("_accepted"))
    tables.quarantine_parquet(rejected.drop("_batch", "_accepted"), f"{quarantine}/_batch={batch}")


def update_dimensions(spark: SparkSession, tenant: str, batch_rows: DataFrame, loaded_at: str) -> None:
    """Insert the members the batch brings and the tables lack, and fill attributes they lack."""
    members = staged(dims.all_members(batch_rows, BOUNDED), "members", partition_by="dimension")

    def update(dim: Dimension) -> None:
        if dim.unbounded:
            _insert_new(spark, tenant, dim.table, dims.build_dimension(batch_rows, dim), loaded_at)
            return
        _insert_new(spark, tenant, dim.table, dims.from_members(_members_of(members, dim.table), dim), loaded_at, written=True)

    # Small jobs on tables of their own: several at a time, the long one first.
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for done in [pool.submit(update, dim) for dim in (*UNBOUNDED, *BOUNDED)]:
            done.result()


def _insert_new(
    spark: SparkSession, tenant: str, table: str, candidates: DataFrame, loaded_at: str, *, written: bool = False
) -> None:
    """Append new members and fill attributes that stored ones lack."""
    spec = DIMENSION_TABLES[table]
    upserts.upsert(candidates, spec.full_name(tenant), spec.grain[0], loaded_at, written=written)


def write_increment(spark: SparkSession, tenant: str, batch_rows: DataFrame, batch: str) -> tuple[list[str], list[str]]:
    """Write the batch's partial sums. Returns all days to rebuild and, of those, the ones only an earlier run had.

    Days are partition values: no more than the calendar has.
    """
    name = table_spec("traffic_increment", "silver").full_name(tenant)
    before = increments.days_of(spark, name, increments.checked_batch(batch))
    lines, day = facts.usage_lines(batch_rows), _call_day(F.col("call_date")).alias("call_day")
    partial = facts.combine_usage(lines).withColumns({"call_day": day, "_batch": F.lit(batch), "batch_of": F.lit(batch)})
    now = tables.values_of(lines.select(day), "call_day")
    tables.overwrite_partitions(partial, name)
    return sorted(before | now), sorted(before - now)


def update_fact(spark: SparkSession, tenant: str, batch: str, days: list[str], stale: list[str], loaded_at: str) -> None:
    """Rebuild the fact's days from the partial sums of all batches, without what the batch no longer has."""
    partial = increments.live(spark, table_spec("traffic_increment", "silver").full_name(tenant), days)
    outdated = (F.col("batch_of") == batch) & F.col("call_day").isin(stale)
    partial = partial.filter(~outdated)
    # Gathered by day before seventeen hashes make the rows wide.
    combined = facts.combine_usage(partial, "call_day").hint("rebalance", F.col("call_day"))
    fact = stamp(facts.key_usage(combined, "call_day"), loaded_at)
    filled = tables.values_of(partial, "call_day")
    tables.replace_values(fact, table_spec("traffic", "silver").full_name(tenant), "call_day", days, filled, gathered=True)


def stored_dimensions(spark: SparkSession, tenant: str) -> Mapping[str, DataFrame]:
    return {d: spark.table(DIMENSION_TABLES[d].full_name(tenant)).drop(upserts.BUCKET) for d in USAGE_DIMENSIONS}


def update_gold(spark: SparkSession, tenant: str, days: list[str], loaded_at: str) -> None:
    """Rebuild the days' daily rows and monthly state, and the monthly rows of their months from the state.

    Other days of a month are read as state only: one row for each group and member of a day.
    """
    fact = spark.table(table_spec("traffic", "silver").full_name(tenant)).filter(F.col("call_day").isin(days))
    daily_name = table_spec("traffic", "gold").full_name(tenant)
    state_name = table_spec("traffic_state", "silver").full_name(tenant)
    daily = staged(stamp(marts.usage_daily(fact, stored_dimensions(spark, tenant), "call_day"), loaded_at), "daily")
    now = {(r["call_month"], r["call_day"]) for r in daily.select("call_month", "call_day").distinct().collect()}
    months = _replace_days(daily, daily_name, days, now)
    # The state may hold months that the daily table has lost already, after a run that stopped in between.
    months |= _replace_days(marts.usage_month_state(daily, "call_day"), state_name, days, now)

    months = sorted(months, key=lambda m: (m is None, m or ""))
    whole = spark.table(state_name).filter(tables.among("call_month", months))
    monthly = stamp(marts.usage_months(marts.merged_state(whole)), loaded_at)
    filled = tables.values_of(whole, "call_month")
    tables.replace_values(monthly, table_spec("traffic_monthly", "gold").full_name(tenant), "call_month", months, filled)


def _replace_days(rows: DataFrame, name: str, days: list[str], now: set[tuple]) -> set[str | None]:
    """Put rebuilt days in place of the old ones; returns the months they were in and are in now.

    A date has one month, so there are no more of them than dates.
    """
    spark = rows.sparkSession
    old = [p for p in tables.partitions_of(spark, name) if p["call_day"] in set(days)]
    tables.overwrite_partitions(rows, name)
    tables.drop_partitions(spark, name, [p for p in old if (p["call_month"], p["call_day"]) not in now])
    return {p["call_month"] for p in old} | {m for m, _ in now}
