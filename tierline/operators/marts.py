"""Gold tables: denormalised daily usage, monthly summary, forecast aggregates and variance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import date_key, is_forecast, variance_pct, year_month
from tierline.functions.keys import UNKNOWN
from tierline.functions.text import ACTUAL, FORECAST
from tierline.model import (
    USAGE_DAILY_COLUMNS,
    USAGE_DIMENSIONS,
    USAGE_MONTHLY_GRAIN,
    Dimension,
)
from tierline.operators.codes import Codes, dictionaries
from tierline.operators.facts import SPREAD, SPREAD_OVER

USAGE_TOTALS = {
    "duration": "total_duration",
    "volume": "total_volume",
    "event_count": "total_event_count",
    "total_charge_sdr_net": "total_charge_sdr_net",
    "total_charge_sdr_gross": "total_charge_sdr_gross",
}
# Published name of each summed measure.
FORECAST_TOTALS = {
    "traffic_volume": "total_traffic_volume",
    "charged_volume": "total_charged_volume",
    "tap_charge_sdr_net": "total_tap_charge_net",
    "tap_charge_sdr_gross": "total_tap_charge_gross",
    "disc_charge_sdr_net": "total_discount_net",
    "disc_charge_sdr_gross": "total_discount_gross",
}


def lookup_columns(table: DataFrame, dim: Dimension) -> DataFrame:
    """The dimension as seen by the star join: fact key name, then daily column names."""
    return table.select(F.col(dim.key).alias(dim.fact_key), *[F.col(src).alias(out) for src, out in dim.daily])


def spread_unknown(table: DataFrame, key: str) -> DataFrame:
    """The dimension for a fact from ``facts.usage_fact_by``: a member that is spelled like the unknown key, if there is one,
    for each value of ``SPREAD``, all others for zero."""
    values = F.when(F.col(key) == F.md5(F.lit(UNKNOWN)), F.sequence(F.lit(0), F.lit(SPREAD_OVER - 1)))
    return table.withColumn(SPREAD, F.explode(F.coalesce(values, F.array(F.lit(0)))))


def usage_daily(fact: DataFrame, dimensions: Mapping[str, DataFrame], *carried: str) -> DataFrame:
    """One denormalised row per fact row; a key without a member yields NULL attributes.

    Every dimension holds one row per key, so the left joins cannot multiply rows. No hints are given: pass
    stored tables, and each dimension broadcasts or not by its measured size. The subscriber dimension is
    joined last. When it is too large to broadcast, that is the only shuffle of the fact, and adaptive
    execution splits the partition of a subscriber (or of the unknown key) that holds much of the rows. A fact from
    ``facts.usage_fact_by`` is placed by subscriber already and does not move.
    """
    daily = fact
    for dim in sorted(USAGE_DIMENSIONS.values(), key=lambda d: d.unbounded):
        looked_up, on = lookup_columns(dimensions[dim.table], dim), [dim.fact_key]
        if dim.unbounded and SPREAD in fact.columns:
            looked_up, on = spread_unknown(looked_up, dim.fact_key), [dim.fact_key, SPREAD]
        daily = daily.join(looked_up, on, "left")
    return daily.select(*USAGE_DAILY_COLUMNS, *[F.col(m).alias(t) for m, t in USAGE_TOTALS.items()], *carried)


# What is counted without repeats: column of the daily table, and the count's name.
COUNTED_MEMBERS = {"imsi": "distinct_imsi_count", "apn": "distinct_apn_count"}
STATE_KEYS = (*USAGE_MONTHLY_GRAIN, "member_kind", "member")


def usage_month_state(daily: DataFrame, *carried: str) -> DataFrame:
    """Mergeable state of the monthly table: one row for each group and member, with the group's sums on the subscribers.

    A set of members is kept as its members, so sets of several days unite by grouping again, exactly, and the sums add up
    beside them. A group that holds a third of the rows spreads over its members.
    """
    first, *others = COUNTED_MEMBERS
    sums = list(USAGE_TOTALS.values())
    rows = [F.struct(F.lit(first).alias("member_kind"), F.col(first).alias("member"), *sums)]
    for kind in others:
        none = [F.lit(None).cast(daily.schema[t].dataType).alias(t) for t in sums]
        rows.append(F.struct(F.lit(kind).alias("member_kind"), F.col(kind).alias("member"), *none))
    each = daily.select(*carried, *USAGE_MONTHLY_GRAIN, F.inline(F.array(*rows)))
    return each.groupBy(*carried, *STATE_KEYS).agg(*[F.sum(t).alias(t) for t in sums])


def merged_state(state: DataFrame) -> DataFrame:
    """States of several days as one."""
    return state.groupBy(*STATE_KEYS).agg(*[F.sum(t).alias(t) for t in USAGE_TOTALS.values()])


def usage_months(state: DataFrame) -> DataFrame:
    """Monthly totals and exact distinct counts from a state with one row for each group and member."""
    return state.groupBy(*USAGE_MONTHLY_GRAIN).agg(
        *[F.sum(t).cast("bigint" if t == "total_event_count" else "decimal(38,6)").alias(t) for t in USAGE_TOTALS.values()],
        *[F.count(F.when(F.col("member_kind") == kind, F.col("member"))).alias(n) for kind, n in COUNTED_MEMBERS.items()],
    )


#: Columns that a daily table may carry to say that its rows lie by subscriber.
PLACED = (USAGE_DIMENSIONS["dim_imsi"].fact_key, SPREAD)
#: Bits of a mask of members.
MASK = 63


def usage_monthly(daily: DataFrame, dimensions: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Monthly totals with exact distinct subscribers and access points: two hash aggregates, and as many shuffles.

    A daily table that carries ``PLACED`` lies by subscriber. Given its dimensions it moves once, as numbers, for each group of access points.
    """
    if dimensions is not None and set(PLACED) <= set(daily.columns):
        codes = dictionaries(_daily_values(dimensions, (*USAGE_MONTHLY_GRAIN, "apn")))
        if "apn" in codes.sizes:
            return _usage_monthly_placed(daily, codes)
    return usage_months(usage_month_state(daily))


def _daily_values(dimensions: Mapping[str, DataFrame], columns: Sequence[str]) -> dict[str, DataFrame]:
    """Where the values of daily columns come from: a column of a dimension each."""
    return {out: dimensions[d.table].select(src) for d in USAGE_DIMENSIONS.values() for src, out in d.daily if out in columns}


def _usage_monthly_placed(daily: DataFrame, codes: Codes) -> DataFrame:
    """The monthly table of daily rows that lie by subscriber.

    A group's rows of one subscriber are put together where they are, so subscribers are counted by sums; one that is spelled like the
    unknown key lies in several tasks and is counted by a flag. Access points become bits of a mask, 63 to a row, which unite exactly
    whatever their number; groups that hold much of the rows are combined before they move.
    """
    key, spread = PLACED
    places = codes.places(USAGE_MONTHLY_GRAIN)
    grain = [*[c for c in USAGE_MONTHLY_GRAIN if c not in places], *dict.fromkeys(p.word for p in places.values())]
    rows = codes.packed(codes.numbered(daily, "apn"), places)
    named, unknown = F.col("imsi").isNotNull(), F.col(key) == F.md5(F.lit(UNKNOWN))
    bit = F.col("apn") - 1
    rows = rows.select(
        *grain, key, spread, *USAGE_TOTALS.values(),
        F.coalesce(F.floor(bit / MASK).cast("int"), F.lit(0)).alias("part"),
        F.coalesce(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(MASK))), F.lit(0).cast("bigint")).alias("mask"),
        F.when(named & ~unknown, 1).otherwise(0).alias("known"), F.when(named & unknown, 1).otherwise(0).alias("unknown"),
    )
    sums = [F.sum(t).alias(t) for t in USAGE_TOTALS.values()]
    flags = [F.max("known").alias("known"), F.max("unknown").alias("unknown")]
    of_one = rows.groupBy(*grain, key, spread, "part").agg(*sums, F.bit_or("mask").alias("mask"), *flags)
    if codes.sizes["apn"] > MASK:
        # A subscriber counts in the first of its rows.
        first = F.row_number().over(Window.partitionBy(*grain, key, spread).orderBy("part")) == 1
        of_one = of_one.withColumn("known", F.when(first, F.col("known")).otherwise(0))
    counted = [F.sum("known").alias("known"), F.max("unknown").alias("unknown")]
    parts = of_one.groupBy(*grain, "part").agg(*sums, F.bit_or("mask").alias("mask"), *counted)
    parts = parts.withColumn("apns", F.bit_count("mask"))
    if codes.sizes["apn"] > MASK:
        parts = parts.groupBy(*grain).agg(*sums, F.sum("apns").alias("apns"), *counted)
    types = {c: daily.schema[c].dataType.simpleString() for c in USAGE_MONTHLY_GRAIN}
    return codes.named(parts, places, types).select(
        *USAGE_MONTHLY_GRAIN,
        *[F.col(t).cast("bigint" if t == "total_event_count" else "decimal(38,6)").alias(t) for t in USAGE_TOTALS.values()],
        (F.col("known") + F.col("unknown")).cast("bigint").alias(COUNTED_MEMBERS["imsi"]),
        F.col("apns").cast("bigint").alias(COUNTED_MEMBERS["apn"]),
    )


def _forecast_totals() -> list[Column]:
    sums = []
    for measure, total in FORECAST_TOTALS.items():
        kind = "decimal(30,2)" if measure.endswith("volume") else "decimal(30,5)"
        sums.append(F.sum(measure).cast(kind).alias(total))
    return [*sums, F.sum("no_of_records").alias("record_count")]


def forecast_by_client_date(fact: DataFrame) -> DataFrame:
    keys = ["client_master_entity_id", "period_start_date", "forecast_or_actual_ind"]
    totals = fact.groupBy(*keys).agg(*_forecast_totals())
    return totals.select(
        F.col(keys[0]).cast("string").alias("client_key"),
        date_key(F.col("period_start_date")).alias("date_key"),
        "forecast_or_actual_ind",
        is_forecast(F.col("forecast_or_actual_ind")).alias("is_forecast"),
        *totals.columns[len(keys) :],
    )


def forecast_by_service_direction(fact: DataFrame) -> DataFrame:
    keys = ["iot_service_type_id", "traffic_direction", "period_start_date", "forecast_or_actual_ind"]
    totals = fact.groupBy(*keys).agg(*_forecast_totals())
    return totals.select(
        F.col(keys[0]).cast("string").alias("service_type_key"),
        F.col("traffic_direction").alias("direction_key"),
        date_key(F.col("period_start_date")).alias("date_key"),
        "forecast_or_actual_ind",
        is_forecast(F.col("forecast_or_actual_ind")).alias("is_forecast"),
        *totals.columns[len(keys) :],
    )


VARIANCE_GRAIN = ("client_master_entity_id", "iot_service_type_id", "traffic_direction", "period_start_date")


def indicator_side(fact: DataFrame, indicator: str, prefix: str) -> DataFrame:
    """Volume and charge of one side, forecast or actual."""
    side = fact.filter(F.col("forecast_or_actual_ind") == indicator)
    return side.groupBy(*VARIANCE_GRAIN).agg(
        F.sum("traffic_volume").alias(f"{prefix}_traffic_volume"),
        F.sum("tap_charge_sdr_net").alias(f"{prefix}_charge_net"),
    )


def _variance_columns(sides: DataFrame) -> DataFrame:
    forecast, actual = F.col("forecast_traffic_volume"), F.col("actual_traffic_volume")
    forecast_charge, actual_charge = F.col("forecast_charge_net"), F.col("actual_charge_net")
    return sides.select(
        F.col("client_master_entity_id").cast("string").alias("client_key"),
        F.col("iot_service_type_id").cast("string").alias("service_type_key"),
        F.col("traffic_direction").alias("direction_key"),
        date_key(F.col("period_start_date")).alias("date_key"),
        forecast.cast("decimal(30,2)").alias("forecast_traffic_volume"),
        forecast_charge.cast("decimal(30,5)").alias("forecast_charge_net"),
        actual.cast("decimal(30,2)").alias("actual_traffic_volume"),
        actual_charge.cast("decimal(30,5)").alias("actual_charge_net"),
        (forecast - actual).cast("decimal(30,2)").alias("variance_traffic"),
        variance_pct(forecast, actual).alias("variance_pct"),
        (forecast_charge - actual_charge).cast("decimal(30,5)").alias("variance_charge"),
    )


def forecast_variance(fact: DataFrame) -> DataFrame:
    """Forecast against actual in one scan and one shuffle; the absent side counts as zero.

    Grouping keeps rows with NULL keys together, which a full outer join would leave unmatched.
    """

    def side(indicator: str, measure: str) -> Column:
        return F.sum(F.when(F.col("forecast_or_actual_ind") == indicator, F.col(measure)))

    zero = F.lit(0).cast("decimal(30,6)")
    sides = (
        fact.filter(F.col("forecast_or_actual_ind").isin(FORECAST, ACTUAL))
        .groupBy(*VARIANCE_GRAIN)
        .agg(
            F.coalesce(side(FORECAST, "traffic_volume"), zero).alias("forecast_traffic_volume"),
            F.coalesce(side(FORECAST, "tap_charge_sdr_net"), zero).alias("forecast_charge_net"),
            F.coalesce(side(ACTUAL, "traffic_volume"), zero).alias("actual_traffic_volume"),
            F.coalesce(side(ACTUAL, "tap_charge_sdr_net"), zero).alias("actual_charge_net"),
        )
    )
    return _variance_columns(sides)


def forecast_variance_by_join(fact: DataFrame) -> DataFrame:
    """The same report as a full outer join of the two sides; NULL keys do not meet.

    Only the measures are zero-filled, never the keys.
    """
    sides = indicator_side(fact, FORECAST, "forecast").join(
        indicator_side(fact, ACTUAL, "actual"), list(VARIANCE_GRAIN), "full_outer"
    )
    measures = [c for c in sides.columns if c not in VARIANCE_GRAIN]
    return _variance_columns(sides.fillna(0, subset=measures))


def forecast_monthly(fact: DataFrame) -> DataFrame:
    keys = ["year_month", "client_master_entity_id", "forecast_or_actual_ind"]
    totals = (
        fact.withColumn("year_month", year_month(F.col("period_start_date")))
        .groupBy(*keys)
        .agg(
            F.sum("traffic_volume").cast("decimal(30,2)").alias("total_traffic_volume"),
            F.sum("charged_volume").cast("decimal(30,2)").alias("total_charged_volume"),
            F.sum(F.col("tap_charge_sdr_net") + F.col("disc_charge_sdr_net"))
            .cast("decimal(30,5)")
            .alias("total_charges_net"),
            F.sum("no_of_records").alias("record_count"),
        )
    )
    return totals.select(
        "year_month",
        F.col("client_master_entity_id").cast("string").alias("client_key"),
        "forecast_or_actual_ind",
        is_forecast(F.col("forecast_or_actual_ind")).alias("is_forecast"),
        *totals.columns[len(keys) :],
    )
