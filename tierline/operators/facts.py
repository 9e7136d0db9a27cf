"""Fact tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import composite_hash, int_key, is_forecast, normalized_or_unknown, packed_texts, row_hash, unpacked_texts
from tierline.functions.keys import UNKNOWN
from tierline.model import FORECAST_MEASURES, FORECAST_TYPES, USAGE_DIMENSIONS, USAGE_FACT_KEYS, USAGE_MEASURES, USAGE_TYPES, Dimension

#: Column that spreads fact rows of the unknown key over tasks, and how many values it has.
SPREAD = "_spread"
SPREAD_OVER = 64


def usage_lines(bronze: DataFrame) -> DataFrame:
    """Bronze text rows as grain columns (normalised, ``unknown`` for NULL) and typed measures."""
    keys = [normalized_or_unknown(F.col(c)).alias(c) for c in USAGE_FACT_KEYS.values()]
    measures = [F.col(m).try_cast(USAGE_TYPES[m]).alias(m) for m in USAGE_MEASURES]
    return bronze.select(*keys, *measures, "source_system", "batch_id")


#: Lineage columns, and the grain columns that move as one text: all but the keys of large dimensions, by which rows may be placed.
LINEAGE = ("source_system", "batch_id")
PACKED = tuple(c for c in USAGE_FACT_KEYS.values() if c not in {d.natural for d in USAGE_DIMENSIONS.values() if d.unbounded})


def combine_usage(
    lines: DataFrame, *extra_keys: str, by: Callable[[list[str]], Mapping[str, Column]] | None = None
) -> DataFrame:
    """Sum the measures by the 17 grain columns; ``min`` stands in for an arbitrary first lineage value.

    Rows move once, to the task of their grain, before they are summed: the grain is nearly that of the records, so sums
    made before the move would hardly be fewer and much wider. Sixteen short texts take much more room in a moving row than one,
    so they move, and are grouped, as one (:func:`packed_texts`). The first step groups by lineage too, so that it only
    sums: a text ``min`` beside the sums would turn the hash aggregate over all records into a sort. The second step
    picks the lineage on the few rows left, in the same tasks. Sums stay decimal and nothing depends on row order.
    Combining combined rows again gives the same answer, which is what the incremental load relies on.

    ``by`` gives expressions of the grain that choose the task in place of the whole grain, from the names of the grain columns that
    move; they become columns after the move, so joins on them find the rows where they are. Grain columns hold no NULL.
    """
    whole = [c for c in USAGE_FACT_KEYS.values() if c not in PACKED]
    narrow = lines.select(*USAGE_MEASURES, *extra_keys, *whole, *LINEAGE, packed_texts(*PACKED).alias("_packed"))
    keys = [*extra_keys, *whole, "_packed"]
    by = by(keys) if by else {}
    grain = [*keys, *by]
    sums = [F.sum(m).alias(m) for m in USAGE_MEASURES]
    moved = narrow.repartition(*(list(by.values()) or keys)).withColumns(by)
    by_lineage = moved.groupBy(*grain, *LINEAGE).agg(*sums)
    combined = by_lineage.groupBy(*grain).agg(*sums, *[F.min(c).alias(c) for c in LINEAGE])
    texts = combined.withColumn("_packed", unpacked_texts(F.col("_packed")))
    one = {c: F.get("_packed", F.lit(i)) for i, c in enumerate(PACKED)}
    return texts.select(
        *extra_keys, *[one.get(c, F.col(c)).alias(c) for c in USAGE_FACT_KEYS.values()], *by, *USAGE_MEASURES, *LINEAGE
    )


def key_usage(combined: DataFrame, *carried: str) -> DataFrame:
    """Replace the grain columns by their hashes and add the row's id and content hash.

    Hashing after the aggregate keeps seventeen 32-character hashes out of the shuffle and computes them
    once per fact row instead of once per record; equal normalised text means equal hash, so the grain is
    the same.
    """
    hashed = combined.select(
        *[F.col(k) if k in combined.columns else F.md5(c).alias(k) for k, c in USAGE_FACT_KEYS.items()],
        *[F.col(m).cast("bigint" if m == "event_count" else "decimal(28,6)").alias(m) for m in USAGE_MEASURES],
        "source_system",
        "batch_id",
        *carried,
    )
    keys = [F.col(k) for k in USAGE_FACT_KEYS]
    return hashed.select(
        composite_hash(*keys).alias("traffic_fact_id"),
        "*",
        row_hash(*keys, *[F.col(m) for m in USAGE_MEASURES]).alias("record_hash"),
    )


def usage_fact(bronze: DataFrame) -> DataFrame:
    return key_usage(combine_usage(usage_lines(bronze)))


def usage_fact_by(bronze: DataFrame, dim: Dimension) -> DataFrame:
    """The usage fact, its rows placed by their key of one large dimension, so that they need not move again to meet it.

    Rows without a member, which may be many, are spread over ``SPREAD_OVER`` values of the column ``SPREAD`` that is added;
    it is zero for all others.
    """
    text = F.col(USAGE_FACT_KEYS[dim.fact_key])

    def placed(names: list[str]) -> dict[str, Column]:
        spread = F.when(text == UNKNOWN, F.pmod(F.xxhash64(*names), F.lit(SPREAD_OVER)).cast("int")).otherwise(0)
        return {dim.fact_key: F.md5(text), SPREAD: spread}

    return key_usage(combine_usage(usage_lines(bronze), by=placed), SPREAD)


def forecast_fact(bronze: DataFrame, partners: DataFrame, agreements: DataFrame, ingestion_id: str) -> DataFrame:
    """Bronze forecast rows with dimension ids; a row without a partner or agreement keeps a NULL id.

    Both joins are left joins to tables unique on the join columns, so rows are neither lost nor repeated.
    No hint is given: the sides broadcast when their measured size is under the session's threshold and
    otherwise meet in a sort-merge join, where adaptive execution splits skewed partners.
    """
    partner_ids = partners.select(
        "partner_name", "partner_group_name", F.col("partner_id").alias("partner_master_entity_id")
    )
    agreement_ids = agreements.select("agreement_reference", "iot_agreement_id")
    joined = bronze.join(partner_ids, ["partner_name", "partner_group_name"], "left").join(
        agreement_ids, "agreement_reference", "left"
    )
    no_id = F.lit(None).cast("bigint")
    return joined.select(
        int_key(F.col("client_name"), F.col("client_group_name")).alias("client_master_entity_id"),
        no_id.alias("client_main_master_entity_id"),
        "partner_master_entity_id",
        no_id.alias("partner_main_master_entity_id"),
        int_key(F.col("service_type")).alias("iot_service_type_id"),
        int_key(F.col("event_type")).alias("iot_event_type_id"),
        int_key(F.col("destination_type")).alias("destination_type_id"),
        "iot_agreement_id",
        int_key(F.col("rti_group")).alias("iot_rti_group_id"),
        "traffic_direction",
        F.to_date("period_start_date").alias("period_start_date"),
        F.to_date("cr_period_start_date").alias("cr_period_start_date"),
        "forecast_or_actual_ind",
        *[F.col(m).cast("decimal(20,6)").alias(m) for m in FORECAST_MEASURES],
        F.col("no_of_records").cast("bigint").alias("no_of_records"),
        row_hash(*[F.col(c) for c in FORECAST_TYPES]).alias("record_hash"),
        F.lit(ingestion_id).alias("ingestion_id"),
    )



def keyed_forecast_fact(bronze: DataFrame) -> DataFrame:
    """Forecast fact in its documented form: hashed keys, measures summed by key.

    Grouped on the normalised text and on days, which are narrower than their text, and hashed afterwards, as the usage fact is.
    """
    sources = {
        "forecast_key": "forecast_or_actual_ind",
        "client_key": "client_name",
        "partner_key": "partner_name",
        "service_type_key": "service_type",
        "event_type_key": "event_type",
        "direction_key": "traffic_direction",
        "destination_key": "destination_type",
        "rti_key": "rti_group",
    }
    texts = [F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))).alias(k) for k, c in sources.items()]
    days = {"date_key": "period_start_date", "charge_period_date_key": "cr_period_start_date"}
    dates = [F.to_date(c).alias(k) for k, c in days.items()]
    lines = bronze.select(
        *texts,
        *dates,
        F.col("agreement_reference").alias("agreement_id"),
        *FORECAST_MEASURES,
        "no_of_records",
        is_forecast(F.col("forecast_or_actual_ind")).alias("forecast"),
    )
    grain = [*sources, "date_key", "agreement_id", "charge_period_date_key"]
    volumes = ("traffic_volume", "charged_volume")
    combined = lines.groupBy(*grain).agg(
        *[F.sum(m).cast("decimal(30,2)" if m in volumes else "decimal(30,5)").alias(m) for m in FORECAST_MEASURES],
        F.sum("no_of_records").alias("number_of_records"),
        F.max(F.when(F.col("forecast"), 1).otherwise(0)).alias("is_forecast"),
    )
    spelled_day = {c: F.date_format(c, "yyyy-MM-dd") for c in days}
    hashed = [F.md5(spelled_day.get(c, F.col(c))).alias(c) if c != "agreement_id" else F.col(c) for c in grain]
    return combined.select(*hashed, *[c for c in combined.columns if c not in grain])

