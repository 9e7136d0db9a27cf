"""Daily counts kept beside a table, so that completeness alerts need no scan of its history.

Each batch stores its own counts by day and category; repeated, it replaces them. Counts of a day's batches are merged like
partial sums (:mod:`tierline.operators.increments`). Alerts read the counts only: one row for each day, category and batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators import increments, quality
from tierline.operators.tables import create_table, overwrite_partitions
from tierline.scratch import staged

COUNTS_DDL = "category string, row_count bigint, last_load timestamp_ntz, batch_of string, call_day string, _batch string"
#: Day of rows without one.
NO_DAY = "unknown"


def create_counts(spark: SparkSession, name: str) -> None:
    create_table(spark, name, COUNTS_DDL, (increments.DAY, increments.BATCH))


def batch_counts(df: DataFrame, loaded_at: str, category: str, batch: str) -> DataFrame:
    """Rows and last load time by day and category of one batch; combined before the shuffle, so a hot day costs no more."""
    moment = F.col(loaded_at).cast("timestamp_ntz")
    day = F.coalesce(F.date_format(moment, "yyyy-MM-dd"), F.lit(NO_DAY))
    counted = df.groupBy(day.alias(increments.DAY), F.col(category).cast("string").alias("category")).agg(
        F.count("*").alias("row_count"), F.max(moment).alias("last_load")
    )
    return counted.withColumns({increments.ORIGIN: F.lit(batch), increments.BATCH: F.lit(batch)})


def update_counts(
    spark: SparkSession, name: str, df: DataFrame, batch: str, loaded_at: str, category: str, compact_at: int = 16
) -> None:
    """Count a batch into the stored counts, in place of what an earlier run of it counted. Reads the batch once."""
    before = increments.days_of(spark, name, increments.checked_batch(batch))
    counted = staged(batch_counts(df, loaded_at, category, batch), "counts")
    # Days of one batch.
    days = {r[0] for r in counted.select(increments.DAY).distinct().collect()}
    overwrite_partitions(counted, name)
    increments.forget(spark, name, batch, before - days)
    increments.compact(spark, name, days, compact_at)


def stored_counts(spark: SparkSession, name: str) -> DataFrame:
    """(day, category, row_count, last_load) over all batches."""
    merged = increments.live(spark, name).groupBy(increments.DAY, "category").agg(
        F.sum("row_count").alias("row_count"), F.max("last_load").alias("last_load")
    )
    return merged.select(F.col(increments.DAY).try_cast("date").alias("day"), "category", "row_count", "last_load")


def alerts(counts: DataFrame, categories: Sequence[str], run_at: str, step: str = "1 DAY") -> DataFrame:
    """The alerts of :func:`quality.completeness_alerts`, from counts."""
    daily = counts.groupBy("day").agg(F.sum("row_count").alias("row_count"))
    return quality.union_all(
        [
            quality.week_over_week(daily),
            quality.missing_days(counts, F.col("day"), F.col("category"), categories, step),
            quality.stale_alert(counts, "last_load", run_at),
        ]
    )
