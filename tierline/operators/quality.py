"""Data-quality, reconciliation, freshness and repair reports.

Every report is an aggregate computed by Spark and returned as a frame of findings. Counting happens before
joining and before listing, so no single key, kind or table gathers its rows in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import is_blank
from tierline.functions.keys import spelled
from tierline.operators.rows import is_empty_row

# Date spellings a landed file may use.
DATE_SPELLINGS = (
    r"^\d{4}-\d{2}-\d{2}$|^\d{1,2}-[A-Za-z]{3}-\d{2,4}$|^\d{1,2}/\d{1,2}/\d{2,4}$|^\d{2,4}/\d{1,2}/\d{1,2}$"
)
# A number after or before repair: digits, thousands commas, fraction, exponent.
REPAIRABLE_NUMBER = r"^[+-]?\d[\d,]*(\.\d+)?([eE][+-]?\d+)?$"
# Tolerated differences between fact and gold totals.
VOLUME_TOLERANCE, CHARGE_TOLERANCE = "1.0", "0.01"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("none")) for p in parts])


def _checks(summary: DataFrame, layer: str, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """One summary row to one row per check (layer, check_name, passed, details)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(layer).alias("layer"),
                F.lit(name).alias("check_name"),
                F.coalesce(passed, F.lit(False)).alias("passed"),
                details.alias("details"),
            )
            for name, passed, details in checks
        ]
    )
    return summary.select(F.explode(rows).alias("c")).select("c.*")


def range_stats(df: DataFrame, measure: str, day: str) -> DataFrame:
    return df.agg(
        F.min(measure).alias("min_value"),
        F.max(measure).alias("max_value"),
        F.avg(measure).cast("decimal(24,6)").alias("avg_value"),
        F.to_date(F.min(day)).alias("min_date"),
        F.to_date(F.max(day)).alias("max_date"),
    )


def duplicate_keys(df: DataFrame, *grain: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*grain).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows against distinct keys."""
    return df.agg(F.count("*").alias("total"), F.count_distinct(key).alias("unique_keys"))


def row_uniqueness(df: DataFrame) -> DataFrame:
    """Rows against distinct whole rows: rows are grouped by content first, so one pass serves both counts.

    Text columns are grouped as one text that only they give: a row moves without the gaps between many short ones.
    """
    texts = [c for c, kind in df.dtypes if kind == "string"]
    others = [F.col(f"`{c}`") for c in df.columns if c not in texts]
    whole = [spelled(*[F.col(f"`{c}`") for c in texts]).alias("whole_text_of_row")] if texts else []
    grouped = df.groupBy(*others, *whole).agg(F.count("*").alias("copies"))
    return grouped.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total"), F.count("*").alias("unique_rows")
    )


def orphans(fact: DataFrame, fact_key: str, dimension: DataFrame, dim_key: str) -> DataFrame:
    """Fact keys the dimension lacks, with the number of fact rows; a NULL key is an orphan.

    The fact is counted per key first, so the anti join handles one row per key and cannot be skewed.
    """
    per_key = fact.groupBy(F.col(fact_key).alias("missing_key")).agg(F.count("*").alias("fact_rows"))
    known = dimension.select(F.col(dim_key).alias("missing_key"))
    return per_key.join(known, "missing_key", "left_anti")


def orphan_count(fact: DataFrame, fact_key: str, dimension: DataFrame, dim_key: str) -> DataFrame:
    missing = orphans(fact, fact_key, dimension, dim_key)
    return missing.agg(F.coalesce(F.sum("fact_rows"), F.lit(0)).alias("orphaned"))


def reconcile_totals(fact: DataFrame, gold: DataFrame) -> DataFrame:
    """Fact and gold totals side by side, with their differences and verdicts.

    The two one-row totals are stacked and folded, which needs neither a join nor a second pass.
    """
    kind = "decimal(38,6)"
    sides = union_all(
        [
            fact.agg(F.sum("traffic_volume").cast(kind).alias("volume"), F.sum("tap_charge_sdr_net").cast(kind).alias("charge"))
            .withColumn("side", F.lit("fact")),
            gold.agg(F.sum("total_traffic_volume").cast(kind).alias("volume"), F.sum("total_tap_charge_net").cast(kind).alias("charge"))
            .withColumn("side", F.lit("gold")),
        ]
    )

    def total(side: str, measure: str) -> Column:
        value = F.max(F.when(F.col("side") == side, F.col(measure)))
        return F.coalesce(value, F.lit(0).cast(kind)).alias(f"{side}_{measure}")

    both = sides.agg(*[total(s, m) for m in ("volume", "charge") for s in ("fact", "gold")])
    volume_diff = F.abs(F.col("fact_volume") - F.col("gold_volume")).cast(kind)
    charge_diff = F.abs(F.col("fact_charge") - F.col("gold_charge")).cast(kind)
    return both.select(
        "*",
        volume_diff.alias("volume_diff"),
        charge_diff.alias("charge_diff"),
        (volume_diff < F.lit(VOLUME_TOLERANCE).cast(kind)).alias("volume_ok"),
        (charge_diff < F.lit(CHARGE_TOLERANCE).cast(kind)).alias("charge_ok"),
    )


def total_beside_fact(fact: DataFrame, gold: DataFrame) -> DataFrame:
    """Gold total with the fact total as a scalar subquery."""
    fact_total = fact.agg(F.sum("traffic_volume").cast("decimal(38,6)")).scalar()
    return gold.agg(F.sum("total_traffic_volume").cast("decimal(38,6)").alias("agg_total_volume")).select(
        "agg_total_volume", fact_total.alias("fact_total_volume")
    )


def validate_bronze(bronze: DataFrame, key: str = "client_name") -> DataFrame:
    summary = bronze.agg(
        F.count("*").alias("n"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.min("traffic_volume").alias("lo"),
        F.max("traffic_volume").alias("hi"),
        F.to_date(F.min("period_start_date")).alias("first"),
        F.to_date(F.max("period_start_date")).alias("last"),
    )
    n, nulls = F.col("n"), F.col("null_keys")
    return _checks(
        summary,
        "bronze",
        [
            ("record_count", n > 0, F.when(n > 0, _text(n, " rows")).otherwise("nothing there")),
            ("null_keys", nulls == 0, F.when(nulls == 0, "every key filled").otherwise(_text(nulls, " keys missing"))),
            ("volume_ranges", F.lit(True), _text("lowest ", F.col("lo"), ", highest ", F.col("hi"))),
            ("date_coverage", F.lit(True), _text("first ", F.col("first"), ", last ", F.col("last"))),
        ],
    )


def validate_dimension(name: str, dimension: DataFrame, key: str) -> DataFrame:
    n, extra = F.col("total"), F.col("total") - F.col("unique_keys")
    return _checks(
        uniqueness(dimension, key),
        "silver",
        [
            (f"{name}_exists", n > 0, F.when(n > 0, _text(n, " rows")).otherwise("nothing there")),
            (f"{name}_uniqueness", extra == 0,
             F.when(extra == 0, "keys differ").otherwise(_text(extra, " keys repeat"))),
        ],
    )


def validate_fact(fact: DataFrame, fact_key: str, dimension: DataFrame, dim_key: str) -> DataFrame:
    summary = fact.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("traffic_volume").isNull() | F.col("charged_volume").isNull()).alias("nulls"),
    )
    n, nulls, missing = F.col("n"), F.col("nulls"), F.col("orphaned")
    counts = _checks(
        summary,
        "silver",
        [
            ("fact_record_count", n > 0, F.when(n > 0, _text(n, " rows")).otherwise("nothing there")),
            ("null_measures", nulls == 0, F.when(nulls == 0, "every measure filled").otherwise(_text(nulls, " rows lack a measure"))),
        ],
    )
    keys = _checks(
        orphan_count(fact, fact_key, dimension, dim_key),
        "silver",
        [
            ("foreign_keys", missing == 0,
             F.when(missing == 0, "every key known").otherwise(_text(missing, " rows with an unknown key"))),
        ],
    )
    return union_all([counts, keys])


def validate_gold(name: str, gold: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Non-empty, and no two rows share the grain: one aggregate gives both counts."""
    summary = (
        gold.groupBy(*grain)
        .agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.count_if(F.col("copies") > 1).alias("duplicated"))
    )
    n, dup = F.col("n"), F.col("duplicated")
    return _checks(
        summary,
        "gold",
        [
            (f"{name}_records", n > 0, F.when(n > 0, _text(n, " rows")).otherwise("nothing there")),
            (f"{name}_duplicates", dup == 0,
             F.when(dup == 0, "grain holds").otherwise(_text(dup, " keys repeat"))),
        ],
    )


def validate_totals(fact: DataFrame, gold: DataFrame) -> DataFrame:
    def verdict(measure: str) -> tuple[str, Column, Column]:
        ok = F.col(f"{measure}_ok")
        return (
            f"{measure}_accuracy",
            ok,
            F.when(ok, "totals agree").otherwise(_text("totals differ by ", F.col(f"{measure}_diff"))),
        )

    return _checks(reconcile_totals(fact, gold), "gold", [verdict("volume"), verdict("charge")])


def validation_summary(checks: DataFrame) -> DataFrame:
    """Passed and failed checks per layer."""
    return checks.groupBy("layer").agg(
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.count("*").alias("total_checks"),
    )


def column_coverage(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Per expected column whether the source has it, and how many rows fill it: one aggregate, one row each."""
    counts = [
        (F.count_if(~is_blank(F.col(c))) if c in df.columns else F.lit(0).cast("bigint")).alias(c) for c in expected
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(c in df.columns).alias("present"), F.col(c).alias("filled_rows")
            )
            for c in expected
        ]
    )
    return df.agg(F.count("*").alias("all_rows"), *counts).select(F.explode(rows).alias("r")).select("r.*")


def cell_values(df: DataFrame, row_id: str, columns: Sequence[str]) -> DataFrame:
    """(row_id, column_name, value) for the listed text columns."""
    present = [c for c in columns if c in df.columns]
    return df.unpivot(row_id, present, "column_name", "value")


def cell_issues(
    df: DataFrame, row_id: str, dates: Sequence[str], decimals: Sequence[str], date_text: str = DATE_SPELLINGS
) -> DataFrame:
    """Filled cells that are no date or number: (row_id, column_name, value, kind).

    Numbers with thousands commas or exponents are repairable and not reported. Pass ``rows.DATE_TEXT`` to
    accept ISO dates only.
    """
    cells = cell_values(df, row_id, [*dates, *decimals]).filter(~is_blank(F.col("value")))
    value = F.trim("value")
    if_date = F.when(~value.rlike(date_text), "INVALID_DATE_FORMAT")
    if_number = F.when(~value.rlike(REPAIRABLE_NUMBER), "INVALID_VALUE")
    kind = F.when(F.col("column_name").isin(*dates), if_date).otherwise(if_number)
    return cells.withColumn("kind", kind).filter(F.col("kind").isNotNull())


def first_issues(issues: DataFrame, row_id: str, n: int = 5) -> DataFrame:
    """The first ``n`` issues of each kind.

    Spark limits each task to ``n`` rows per kind before the shuffle, so a kind that covers most of the
    table still arrives as a handful of rows.
    """
    order = Window.partitionBy("kind").orderBy(row_id, "column_name", "value")
    return issues.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("kind", "column_name").agg(F.count("*").alias("cells"))


def missing_required_rows(df: DataFrame, row_id: str, column: str, n: int = 10) -> DataFrame:
    """The first ``n`` rows without the required value."""
    missing = df.filter(is_blank(F.col(column)))
    return missing.select(row_id, F.lit(f"no value for {column}").alias("reason")).orderBy(row_id).limit(n)


def repair_stats(df: DataFrame, decimals: Sequence[str]) -> DataFrame:
    """Per column, how many cells the number repair rewrites and how many it cannot read."""
    present = [c for c in decimals if c in df.columns]
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in present])).alias("s")).select("s.*")
    value = F.trim("value")
    return cells.groupBy("column_name").agg(
        F.count_if(value.rlike("[eE]") & value.rlike(REPAIRABLE_NUMBER)).alias("exponent_conversions"),
        F.count_if(value.contains(",")).alias("separator_removals"),
        F.count_if(~is_blank(F.col("value")) & ~value.rlike(REPAIRABLE_NUMBER)).alias("unreadable"),
        F.count_if(is_blank(F.col("value"))).alias("blank"),
    )


def empty_row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"), F.count_if(is_empty_row(df.columns)).alias("empty_rows"))


def rows_per_day(df: DataFrame, day: Column) -> DataFrame:
    return df.groupBy(day.cast("date").alias("day")).agg(F.count("*").alias("row_count"))


def freshness(df: DataFrame, loaded_at: str, run_at: str) -> DataFrame:
    """Last load, record count and whether the last load is older than a day at ``run_at``."""
    latest = F.col("last_load")
    limit = F.lit(run_at).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")
    summary = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("last_load"), F.count("*").alias("records"))
    return summary.select(
        F.date_format(latest, "yyyy-MM-dd HH:mm:ss").alias("last_load"),
        "records",
        F.when(latest < limit, "STALE_DATA").otherwise("OK").alias("status"),
    )


def week_over_week(daily: DataFrame, tolerance_pct: int = 20) -> DataFrame:
    """Days whose row count differs from the same day a week earlier by more than the tolerance.

    An equi-join on the shifted day: unlike a lag over an unpartitioned window it does not gather the
    calendar in one task, and a gap in the calendar does not shift the comparison. A day up to the last one seen that has
    no rows at all, a week after one that had some, deviates like any other.
    """
    last = daily.agg(F.max("day").alias("last_day"))
    earlier = daily.select(F.date_add("day", 7).alias("day"), F.col("row_count").alias("previous"))
    due = earlier.join(F.broadcast(last), F.col("day") <= F.col("last_day")).drop("last_day")
    both = due.join(daily, "day", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    deviates = F.abs(F.col("row_count") - F.col("previous")) * 100 > F.col("previous") * tolerance_pct
    return both.filter(deviates).select(
        "day",
        F.lit("volume_deviation").alias("alert"),
        _text(F.col("row_count"), " rows, ", F.col("previous"), " a week earlier").alias("details"),
    )


def missing_days(df: DataFrame, day: Column, category: Column, categories: Sequence[str], step: str) -> DataFrame:
    """Calendar days, from first to last, on which a category has no row at all."""
    seen = df.select(day.cast("date").alias("day"), category.alias("category")).distinct()
    calendar = (
        seen.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
        .select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias("day"))
        .select("day", F.explode(F.array(*[F.lit(c) for c in categories])).alias("category"))
    )
    return calendar.join(seen, ["day", "category"], "left_anti").select(
        "day", F.lit("no_records").alias("alert"), F.concat(F.lit("no rows for "), "category").alias("details")
    )


def stale_alert(df: DataFrame, loaded_at: str, run_at: str) -> DataFrame:
    stale = freshness(df, loaded_at, run_at).filter(F.col("status") == "STALE_DATA")
    return stale.select(
        F.lit(run_at).cast("timestamp_ntz").cast("date").alias("day"),
        F.lit("stale").alias("alert"),
        F.concat(F.lit("last load "), "last_load").alias("details"),
    )


def completeness_alerts(
    df: DataFrame, loaded_at: str, category: str, categories: Sequence[str], run_at: str, step: str = "1 DAY"
) -> DataFrame:
    """Weekly deviation, days without records of a category, and stale loads as (day, alert, details)."""
    return union_all(
        [
            week_over_week(rows_per_day(df, F.col(loaded_at))),
            missing_days(df, F.col(loaded_at), F.col(category), categories, step),
            stale_alert(df, loaded_at, run_at),
        ]
    )


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Schema, table, row and column counts."""
    rows = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name.rpartition(".")[0]).alias("table_schema"),
            F.lit(name.rpartition(".")[2]).alias("table_name"),
            F.lit(len(df.columns)).alias("column_count"),
            "row_count",
        )
        for name, df in tables.items()
    ]
    return union_all(rows).orderBy("table_schema", "table_name")
