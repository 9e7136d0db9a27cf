"""Ad-hoc reports over stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.text import ACTUAL, FORECAST
from tierline.operators.rows import last_days


def top_clients(by_client_date: DataFrame, clients: DataFrame, run_date: str, days: int = 7, n: int = 10) -> DataFrame:
    """Largest clients by volume over the last days.

    Volumes are summed per client before the join, so the join sees one row per client whatever the input
    size; ties break on the client name.
    """
    recent = last_days(by_client_date.withColumn("day", F.to_date("date_key")), "day", days, run_date)
    volumes = recent.groupBy("client_key").agg(F.sum("total_traffic_volume").alias("volume"))
    return (
        volumes.join(clients.select("client_key", "client_name"), "client_key")
        .select("client_name", F.col("volume").cast("decimal(38,2)").alias("volume"))
        .orderBy(F.desc("volume"), "client_name")
        .limit(n)
    )


def pair_activity(bronze: DataFrame) -> DataFrame:
    """Rows and distinct call dates per client and partner."""
    return bronze.groupBy("client_pmn", "partner_pmn").agg(
        F.count("*").alias("row_count"), F.count_distinct("call_date").alias("distinct_dates")
    )


def top_pairs(bronze: DataFrame, n: int = 5) -> DataFrame:
    """Busiest pairs, ties broken by name."""
    return pair_activity(bronze).orderBy(F.desc("row_count"), "client_pmn", "partner_pmn").limit(n)


def variance_rollup(variance: DataFrame) -> DataFrame:
    """Total and mean variance per date, latest first.

    Few dates over many rows: partial sums leave each task with one row per date before the shuffle, and
    only that small result is sorted.
    """
    return (
        variance.groupBy("date_key")
        .agg(
            F.sum("variance_traffic").cast("decimal(38,2)").alias("total_variance"),
            F.avg("variance_pct").cast("decimal(14,6)").alias("avg_variance_pct"),
        )
        .orderBy(F.desc("date_key"))
    )


def fa_ratio(gold: DataFrame) -> DataFrame:
    """Forecast and actual fact records behind the gold rows; rows of other indicators are neither."""

    def records(indicator: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("forecast_or_actual_ind") == indicator, F.col("record_count"))), F.lit(0))

    return gold.agg(records(FORECAST).alias("forecast_records"), records(ACTUAL).alias("actual_records"))


def union_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result.orderBy("table_name")


def settlement_report(settlement: DataFrame) -> DataFrame:
    """Settled amounts listed by period, country, partner and service.

    A total order over a table goes through a range shuffle on the sort key, not through one task.
    """
    keys = ["traffic_period", "country", "partner_pmn", "service_type"]
    return (
        settlement.groupBy(*keys)
        .agg(F.count("*").alias("record_count"), F.sum("tap_charges_excl_tax").cast("decimal(28,6)").alias("amount"))
        .orderBy(*keys)
    )
