"""Forecast records from landed files to daily, variance and monthly tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.model import DIMENSION_TABLES, FORECAST_TYPES, TABLES, TableSpec, table_spec
from tierline.operators import dimensions as dims
from tierline.operators import facts, marts, quality, tables
from tierline.operators.codes import Codes, dictionaries
from tierline.operators.rows import any_of, split_whole, unreadable
from tierline.operators.shape import (
    add_load_columns,
    cast_columns,
    lowercase_columns,
    select_available,
    stamp,
)
from tierline.scratch import staged
from tierline.sources.files import SOURCE_PATH, SOURCE_REASON, SOURCE_TEXT, read_rescued

FORECAST_DIMENSIONS = ("dim_forecast_actual", "dim_partner", "dim_agreement")
GOLD = {
    "forecast": marts.forecast_by_client_date,
    "forecast_service": marts.forecast_by_service_direction,
    "forecast_variance": marts.forecast_variance,
}


def forecast_bronze(raw: DataFrame, loaded_at: str) -> DataFrame:
    """Lower-case headers, typed columns, load time; unknown columns dropped."""
    typed = cast_columns(lowercase_columns(raw), FORECAST_TYPES)
    return add_load_columns(select_available(typed, list(FORECAST_TYPES)), loaded_at)


#: Reason of a good row whose file is held back for another one.
HELD = "file"


def split_forecast(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, unreadable) rows; a value that does not fit its type holds back its whole file, as the file's load would fail.

    Unreadable rows carry ``error_message``: the columns that cannot be read, ``cells`` for a row that its header does not fit,
    or ``file`` for the other rows of its file. Rows without a path stand for themselves.
    """
    named = lowercase_columns(raw)
    reason = F.nullif(unreadable(dict(named.dtypes), FORECAST_TYPES), F.lit(""))
    if SOURCE_REASON in named.columns:
        reason = F.coalesce(F.col(SOURCE_REASON), reason)
    if SOURCE_PATH not in named.columns:
        named = named.withColumn(SOURCE_PATH, F.lit(None).cast("string"))
    good, bad = split_whole(named.withColumn("error_message", reason), F.col("error_message").isNotNull(), SOURCE_PATH)
    return good.drop("error_message"), bad.fillna(HELD, ["error_message"])


def read_forecast(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Landed forecast files, typed by the reader; rows that cannot be read keep their text and the reason."""
    return read_rescued(spark, paths, FORECAST_TYPES)


def build_dimensions(bronze: DataFrame, run_at: str) -> dict[str, DataFrame]:
    return {
        "dim_forecast_actual": dims.forecast_actual_dimension(bronze),
        "dim_partner": dims.partner_dimension(bronze, run_at),
        "dim_agreement": dims.agreement_dimension(bronze, run_at),
    }


def forecast_fact(
    bronze: DataFrame, run_at: str, ingestion_id: str = "forecast_001", *, written: bool = False
) -> DataFrame:
    """Fact of bronze rows with ids of their own dimensions.

    With ``written`` the dimensions are written first, so that their true sizes decide how the whole rows meet them; else a
    dimension whose ids nobody uses is not even built.
    """
    built = build_dimensions(bronze, run_at)
    partners, agreements = built["dim_partner"], built["dim_agreement"]
    if written:
        partners, agreements = staged(partners, "dim_partner"), staged(agreements, "dim_agreement")
    return facts.forecast_fact(bronze, partners, agreements, ingestion_id)


def quality_report(bronze: DataFrame, dimensions: dict[str, DataFrame], fact: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    """Every check of every layer: (layer, check_name, passed, details). ``gold`` is keyed by domain."""
    checks = [quality.validate_bronze(bronze)]
    checks += [quality.validate_dimension(name, d, DIMENSION_TABLES[name].grain[0]) for name, d in dimensions.items()]
    checks.append(quality.validate_fact(fact, "partner_master_entity_id", dimensions["dim_partner"], "partner_id"))
    for domain, frame in gold.items():
        spec = TABLES[domain, "gold"]
        checks.append(quality.validate_gold(spec.name, frame, spec.grain))
    checks.append(quality.validate_totals(fact, gold["forecast"]))
    return quality.union_all(checks)


def forecast_specs() -> list[TableSpec]:
    gold = [table_spec(domain, "gold") for domain in (*GOLD, "forecast_monthly")]
    return [
        table_spec("forecast", "bronze"),
        *[DIMENSION_TABLES[d] for d in FORECAST_DIMENSIONS],
        table_spec("forecast", "silver"),
        *gold,
    ]


def create_forecast_tables(spark: SparkSession, tenant: str) -> None:
    tables.create_schemas(spark, tenant)
    for spec in forecast_specs():
        tables.create_from_spec(spark, tenant, spec)


def _by_period(bronze: DataFrame, partners: DataFrame, agreements: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """Bronze rows gathered by the period of their fact, before hashes and ids make them wide, and moved with numbers for their texts.

    The dimensions come back as the batch needs them: its own members, broadcast, as their texts are few; where they are not, the joins
    may move the rows again, and they do not count as gathered.
    """
    texts = [c for c, kind in FORECAST_TYPES.items() if kind == "string"]
    codes = dictionaries({c: bronze.select(c) for c in texts})
    places = codes.places(texts)
    period = bronze.select(*FORECAST_TYPES, F.to_date("period_start_date").alias("_period"))
    rows = codes.named(codes.packed(period, places).hint("rebalance", F.col("_period")), places, FORECAST_TYPES)
    gathered = {"partner_name", "agreement_reference"} <= set(places)
    if gathered:
        partners = F.broadcast(_own(partners, "partner_name", codes))
        agreements = F.broadcast(_own(agreements, "agreement_reference", codes))
    return rows.select(*FORECAST_TYPES), partners, agreements, gathered


def _own(dimension: DataFrame, column: str, codes: Codes) -> DataFrame:
    return dimension.join(F.broadcast(codes.of(column)), F.col(column) == F.col("value"), "left_semi")


def load_forecast(
    spark: SparkSession, tenant: str, raw: DataFrame, batch: str, loaded_at: str, quarantine: str | None = None, written: bool = False
) -> None:
    """One batch through all layers; only the periods it holds, or held in an earlier run, are rebuilt. Safe to repeat.

    No value is silently lost: with ``quarantine`` the files that hold an unreadable value go there whole, with reasons; without,
    such a value fails the load before anything is written. ``written`` rows are read from written rows already, and not written once
    more before they are judged.
    """
    create_forecast_tables(spark, tenant)
    bronze_name = table_spec("forecast", "bronze").full_name(tenant)
    raw = raw if written else staged(raw, "landed")
    good, bad = split_forecast(raw)
    if quarantine:
        held = bad.select([F.col(c).cast("string").alias(c) for c in bad.columns])
        tables.quarantine_csv(held, f"{quarantine}/_batch={batch}")
    else:
        first = bad.filter(F.col("error_message") != HELD).first()
        if first is not None:
            raise ValueError(f"unreadable {first['error_message']} in {first[SOURCE_PATH] or 'the batch'}")
    tables.replace_batch(forecast_bronze(good, loaded_at).withColumn("_batch", F.lit(batch)), bronze_name, batch)
    bronze = spark.table(bronze_name).filter(F.col("_batch") == batch)

    for name, built in build_dimensions(bronze, loaded_at).items():
        spec = DIMENSION_TABLES[name]
        stored = spark.table(spec.full_name(tenant))
        tables.append_table(dims.new_members(built, stored, spec.grain[0]), spec.full_name(tenant))

    stored = {d: spark.table(DIMENSION_TABLES[d].full_name(tenant)) for d in FORECAST_DIMENSIONS}
    fact_name = table_spec("forecast", "silver").full_name(tenant)
    before = {p["period_start_date"] for p in tables.partitions_of(spark, fact_name, _batch=batch)}
    now = tables.values_of(bronze.select(F.to_date("period_start_date").alias("period")), "period")
    rows, partners, agreements, gathered = _by_period(bronze, stored["dim_partner"], stored["dim_agreement"])
    fact = stamp(facts.forecast_fact(rows, partners, agreements, f"forecast_{batch}"), loaded_at)
    tables.overwrite_partitions(fact.withColumn("_batch", F.lit(batch)), fact_name, gathered=gathered)
    periods = sorted(before | now, key=lambda p: (p is None, p or ""))
    stale = [p for p in periods if p not in now]

    whole = spark.table(fact_name)
    outdated = (F.col("_batch") == batch) & tables.among("period_start_date", stale)
    whole = whole.filter(~F.coalesce(outdated, F.lit(False)))
    touched = whole.filter(tables.among("period_start_date", periods))
    for domain, build in GOLD.items():
        name = table_spec(domain, "gold").full_name(tenant)
        tables.replace_values(stamp(build(touched), loaded_at), name, "date_key", periods)
    months = sorted({p and p[:7] for p in periods}, key=lambda m: (m is None, m or ""))
    # Ranges of the partition column, so only the months' partitions are read.
    day = F.col("period_start_date")
    in_months = [day.isNull() if m is None else (day >= F.lit(f"{m}-01").cast("date")) & (day <= F.last_day(F.lit(f"{m}-01").cast("date"))) for m in months]
    monthly = stamp(marts.forecast_monthly(whole.filter(any_of(in_months))), loaded_at)
    tables.replace_values(monthly, table_spec("forecast_monthly", "gold").full_name(tenant), "year_month", months)
    # Last, so that a run that stops before knows from them which periods to rebuild.
    tables.drop_partitions(spark, fact_name, [{"period_start_date": p, "_batch": batch} for p in stale])


def stored_quality_report(spark: SparkSession, tenant: str) -> DataFrame:
    """The report over the stored tables of a tenant."""
    read = {s.name: spark.table(s.full_name(tenant)) for s in forecast_specs()}
    gold = {domain: read[table_spec(domain, "gold").name] for domain in (*GOLD, "forecast_monthly")}
    dimensions = {d: read[d] for d in FORECAST_DIMENSIONS}
    return quality_report(read["iot_forecast_raw"], dimensions, read["fact_iot_forecast"], gold)
