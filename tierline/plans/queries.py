"""Named queries over a folder of star-schema tables. Each takes (spark, folder) and returns a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import blank_to_null, is_blank
from tierline.model import (
    DIMENSION_TABLES,
    SETTLEMENT_DDL,
    SETTLEMENT_REQUIRED_COLUMNS,
    USAGE_ALIASES,
    USAGE_DIMENSIONS,
    USAGE_TYPES,
    schema_of,
    table_spec,
)
from tierline.operators import dimensions as dims
from tierline.operators import counts, facts, marts, quality, reports, rows, shape, tables, upserts
from tierline.plans import forecast, settlement, usage
from tierline.plans.usage import clean_usage, split_usage, usage_bronze
from tierline.scratch import already_stored, scratch_path, staged, stored
from tierline.session import wide_rows
from tierline.sources import derived
from tierline.sources.files import SOURCE_PATH, detect_layouts, discover_files, read_delimited, read_files, tenant_of
from tierline.sources.tables import list_tables, read_table
from tierline.streaming.landing import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

# Results are stamped and judged as of this moment, so they do not depend on the day they run.
RUN_AT = "2026-07-01 00:00:00"

# How delimited files land where their folder is written for one query.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _usage_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Landed usage records, as text."""
    return stored(spark, folder, "usage_raw", lambda: derived.usage_raw(spark, folder))


def _usage_records(spark: SparkSession, folder: str) -> DataFrame:
    """Landed usage records for a query that reads them once: not written for it where nothing else has."""
    landed = already_stored(spark, folder, "usage_raw")
    return derived.usage_raw(spark, folder) if landed is None else landed


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    """The bronze usage table: valid rows of the landed records, made without writing those where nothing else has."""
    with wide_rows(spark):
        return stored(spark, folder, "usage_bronze", lambda: usage_bronze(_usage_records(spark, folder)))


def _forecast_bronze(spark: SparkSession, folder: str) -> DataFrame:
    def build():
        return forecast.forecast_bronze(derived.forecast_raw(spark, folder), RUN_AT)

    return stored(spark, folder, "forecast_bronze", build)


def _forecast_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The forecast fact over stored bronze rows. Not written: hashes and ids that a report does not use need not be made."""
    return forecast.forecast_fact(_forecast_bronze(spark, folder), RUN_AT)


def _settlement_raw(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "settlement_raw", lambda: derived.settlement_raw(spark, folder))


def _settlement(spark: SparkSession, folder: str) -> DataFrame:
    return settlement.clean_settlement(_settlement_raw(spark, folder))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return derived.table(spark, folder, "events")


# Ingest


@query
def ingest_clean(spark, folder):
    return clean_usage(_usage_raw(spark, folder))


@query
def split_valid(spark, folder):
    return split_usage(clean_usage(_usage_raw(spark, folder)))[0]


@query
def split_invalid(spark, folder):
    return split_usage(clean_usage(_usage_raw(spark, folder)))[1]


@query
def split_stats(spark, folder):
    cleaned = clean_usage(_usage_raw(spark, folder))
    return rows.split_stats(cleaned, rows.type_violation(cleaned.columns, USAGE_TYPES))


@query
def align_schema(spark, folder):
    """Bronze rows in the column order of the registered table, typed as in silver."""
    target = schema_of(", ".join(f"{c} {USAGE_TYPES.get(c, 'string')}" for c in USAGE_ALIASES))
    return shape.align_to_schema(_bronze(spark, folder), target)


@query
def alias_coalesce(spark, folder):
    """Row-wise alias choice: the billed minutes, or the plain duration where they are blank."""
    named = shape.normalize_columns(rows.filter_empty_rows(_usage_raw(spark, folder)))
    readable = named.withColumn("billed_minutes", F.when(named.billed_minutes != "n/a", named.billed_minutes))
    merged = shape.coalesce_aliases(readable, {"minutes": ("billed_minutes", "duration")})
    return merged.groupBy("minutes").agg(F.count("*").alias("row_count"))


@query
def clean_rows(spark, folder):
    """Forecast rows typed, stamped and cleared of blanks and of rows without client."""
    typed = _forecast_bronze(spark, folder)
    named = rows.not_null(typed, "client_name", "client_group_name")
    return named.select(
        "client_name",
        blank_to_null(F.col("partner_name")).alias("partner_name"),
        F.date_format("period_start_date", "yyyy-MM-dd").alias("period"),
        "traffic_volume",
        "charged_volume",
        "tap_charge_sdr_gross",
        "disc_charge_sdr_gross",
        "no_of_records",
        "forecast_or_actual_ind",
        "_load_date",
    )


def _drop(spark: SparkSession, folder: str) -> str:
    """A landing folder: usage records of two tenants in two delimited layouts and as Parquet."""
    root = scratch_path(spark, "landing")
    raw = _usage_raw(spark, folder)
    batch = F.coalesce(F.col("Batch ID"), F.lit("F"))
    layouts = {"F": ("North/Bronze/Traffic", ";"), "O": ("South/bronze/traffic", "|"), "P": ("South/bronze/traffic/late", None)}
    for status, (place, delimiter) in layouts.items():
        # Blank rows have a blank status: they land beside the first layout.
        known = F.when(batch.isin("O", "P"), batch).otherwise("F")
        part = raw.filter(known == status)
        writer = part.write.mode("overwrite")
        if delimiter is None:
            shape.normalize_columns(part).write.parquet(f"{root}/tenant/{place}")
        else:
            writer.options(
                header=True, sep=delimiter, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
            ).csv(f"{root}/tenant/{place}")
    return root


def _last(df: DataFrame, column: Column) -> str:
    """The latest day or time in the data, as text: what reports look back from."""
    return str(df.agg(F.max(column)).first()[0])


def _landed(spark: SparkSession, root: str) -> list[str]:
    return [r.path for r in discover_files(spark, root, "traffic", "bronze").select("path").collect()]


@query
def landing_ingest(spark, folder):
    """Discover, detect layouts, read, clean and split a mixed drop of the whole usage input."""
    raw = read_files(spark, _landed(spark, _drop(spark, folder)), aliases=USAGE_ALIASES)
    path = F.col(SOURCE_PATH)
    audited = shape.add_audit_columns(
        usage_bronze(raw), path, tenant=tenant_of(path), layer="bronze", domain="traffic", ingested_at=RUN_AT
    )
    return audited.select(
        *[c for c in USAGE_ALIASES if c in audited.columns],
        "_tenant", "_layer", "_stage", "_source_format", "_ingest_date",
    )


@query
def delimiter_detect(spark, folder):
    """Delimiter and column count per landed layout."""
    root = scratch_path(spark, "layouts")
    layouts = {"nation": "~", "supplier": ",", "customer": ";", "part": "|", "orders": "\t"}
    for name, delimiter in layouts.items():
        derived.table(spark, folder, name).write.options(header=True, sep=delimiter).csv(f"{root}/{name}")
    found = detect_layouts(spark, [f"{root}/{name}" for name in layouts])
    name = F.element_at(F.split("path", "/"), -2)
    fields = F.size(F.split("header", F.concat(F.lit("["), "delimiter", F.lit("]"))))
    return found.select(name.alias("table_name"), "delimiter", fields.alias("column_count")).distinct()


@query
def stream_ingest(spark, folder):
    """The mixed drop through the file stream into a bronze store; equals the batch ingest."""
    root, store = _drop(spark, folder), scratch_path(spark, "bronze")

    _stream_to(spark, root, store)
    return spark.read.parquet(store).select(clean_usage(_usage_raw(spark, folder)).columns)


def _stream_to(spark: SparkSession, root: str, store: str) -> None:
    def handler(tenant: str, raw: DataFrame, batch: str, loaded_at: str) -> None:
        del loaded_at
        valid, _ = split_usage(clean_usage(raw))
        aligned = shape.align_to_schema(valid, schema_of(", ".join(f"{c} string" for c in USAGE_ALIASES)))
        aligned.write.mode("overwrite").parquet(f"{store}/_tenant={tenant}/_batch={batch}")

    stream = ingest_stream(
        spark, root, "traffic", "bronze", scratch_path(spark, "stream"), handler, files_per_batch=10, aliases=USAGE_ALIASES
    )
    stream.awaitTermination()


@query
def stream_two_tenants(spark, folder):
    """Rows and volume by tenant store and client after one stream over the files of two tenants."""
    root, store = _drop(spark, folder), scratch_path(spark, "bronze")
    _stream_to(spark, root, store)
    stored = spark.read.parquet(store)
    return stored.groupBy(F.col("_tenant").alias("tenant"), "event_type_id", "client_pmn").agg(
        F.count("*").alias("row_count"), F.sum(F.col("volume").try_cast("decimal(18,6)")).alias("volume")
    )


@query
def mixed_headers(spark, folder):
    """One batch of three layouts: two families of headers for the same columns, and one without the partner column.

    The files land packed: as plain text they would be many times their tables.
    """
    root = scratch_path(spark, "layouts")
    raw = _usage_raw(spark, folder)
    status = F.coalesce(F.col("Batch ID"), F.lit("F"))
    other = {"Client Operator": "IoT Client PMN", "RP-TADIG": "Partner PMN", "Billed Minutes": "Actual Minutes", "CDR Count": "Number of SMS", "File Direction": "Traffic Direction"}
    layouts = {
        "a": raw.filter(status == "O"),
        "b": raw.filter(status == "P").withColumnsRenamed(other),
        "c": raw.filter(~status.isin("O", "P")).drop("RP-TADIG"),
    }
    for name, part in layouts.items():
        writer = part.write.options(header=True, sep=";", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        writer.options(**PACKED).csv(f"{root}/{name}")
    landed = read_delimited(spark, [f"{root}/{name}" for name in layouts], aliases=USAGE_ALIASES)
    return clean_usage(landed).select(clean_usage(raw).columns)


@query
def split_reasons(spark, folder):
    """Rejected rows by the columns that do not fit."""
    cleaned = clean_usage(_usage_records(spark, folder))
    invalid = split_usage(cleaned)[1].withColumn("reason", usage.usage_reasons(cleaned.columns))
    return invalid.groupBy("reason").agg(F.count("*").alias("row_count"))


# Stored loads


def _own_tenant(name: str) -> str:
    """A tenant of this run's own, so that runs in one session do not meet."""
    return f"{name}_{uuid.uuid4().hex[:8]}"


def _pathed(df: DataFrame, place: str) -> DataFrame:
    return df.withColumn(SOURCE_PATH, F.lit(f"s3a://landing/tenant/north/{place}/file.csv"))


@query
def forecast_reload(spark, folder):
    """Daily client totals after two batches, the first loaded again on another day without its oldest year."""
    tenant = _own_tenant("reload")
    raw = stored(spark, folder, "forecast_raw", lambda: derived.forecast_raw(spark, folder))
    incoming = F.col("TRAFFIC_DIRECTION") == "CR"
    year = F.substring("PERIOD_START_DATE", 1, 4).cast("int")
    oldest = -int(_last(raw, -year))
    loads = (("0", raw.filter(incoming), 1), ("1", raw.filter(~incoming), 1), ("0", raw.filter(incoming & (year > oldest)), 2))
    for batch, part, day in loads:
        forecast.load_forecast(spark, tenant, part, batch, f"2026-01-0{day} 00:00:00", None, True)
    return spark.table(table_spec("forecast", "gold").full_name(tenant)).drop("created_at", "updated_at")


def _by_month(raw: DataFrame) -> DataFrame:
    """Usage records with the first of the month for the day, in the spelling they have: as many call days as months."""
    day = F.col("Call Date")
    first = (
        F.when(day.rlike(r"^\d{8}$"), F.concat(F.substring(day, 1, 6), F.lit("01")))
        .when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(F.substring(day, 1, 8), F.lit("01")))
        .when(day.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.concat(F.lit("01"), F.substring(day, 3, 8)))
        .otherwise(day)
    )
    return raw.withColumn("Call Date", first)


@query
def usage_reload(spark, folder):
    """Monthly totals after three loads of two batches through all layers, the first batch at last without its oldest year.

    Partial sums are merged as soon as two batches meet, so the last load replaces rows of a merged batch.
    """
    tenant = _own_tenant("reload")
    raw = _pathed(_by_month(_usage_raw(spark, folder)), "Bronze/Traffic")
    open_ = F.coalesce(F.col("Batch ID"), F.lit("")) == "O"
    year = F.substring("Call Month", 1, 4).try_cast("int")
    oldest = -int(_last(raw, -year))
    loads = (("0", raw.filter(open_), 1), ("1", raw.filter(~open_), 1), ("0", raw.filter(open_ & (year > oldest)), 2))
    for batch, part, day in loads:
        bad = scratch_path(spark, "quarantine")
        usage.load_usage(spark, tenant, part, batch, f"2026-01-0{day} 00:00:00", bad, compact_at=2)
    return spark.table(table_spec("traffic_monthly", "gold").full_name(tenant)).drop("created_at", "updated_at")


def _forecast_files(spark: SparkSession, folder: str) -> str:
    """Forecast records as one delimited file for each partner group, with values of some partners that cannot be read.

    The rows of a group are gathered before their values become text, which is many times as wide.
    """
    raw = derived.forecast_raw(spark, folder, gathered_by="s_nation")
    odd = F.col("FORECAST_OR_ACTUAL_IND") == "X"
    spoiled = raw.withColumns(
        {
            "TRAFFIC_VOLUME": F.when(odd & F.endswith("PARTNER_NAME", F.lit("3")), "n/a").otherwise(F.col("TRAFFIC_VOLUME")),
            "PERIOD_START_DATE": F.when(odd & F.col("PARTNER_NAME").rlike("[39]$"), "soon").otherwise(F.col("PERIOD_START_DATE")),
            "NO_OF_RECORDS": F.when(odd & F.endswith("PARTNER_NAME", F.lit("5")), "1.5").otherwise(F.col("NO_OF_RECORDS")),
            "delivery": F.col("PARTNER_GROUP_NAME"),
        }
    )
    root = scratch_path(spark, "forecast")
    spoiled.write.partitionBy("delivery").options(header=True, sep=";", **PACKED).csv(root)
    return root


def _files_under(spark: SparkSession, root: str) -> list[str]:
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.csv.gz").load(root)
    return [r.path for r in files.select("path").collect()]


@query
def forecast_split_reasons(spark, folder):
    """Typed read of forecast files: rows taken, and rows held back by what cannot be read in them or in their file."""
    landed = forecast.read_forecast(spark, _files_under(spark, _forecast_files(spark, folder)))
    good, bad = forecast.split_forecast(staged(landed, "landed"))
    judged = good.withColumn("reason", F.lit("")).unionByName(bad.withColumnRenamed("error_message", "reason"))
    return judged.groupBy("partner_group_name", "reason").agg(F.count("*").alias("row_count"), F.sum("traffic_volume").alias("volume"))


@query
def settlement_reload(spark, folder):
    """Settlement rows after two batches, the first loaded again on another day without its VR rows."""
    tenant, bad = _own_tenant("reload"), scratch_path(spark, "quarantine")
    raw = _pathed(_settlement_raw(spark, folder), "Gold/Settlement")
    open_ = F.col("Event Type") == "O"
    settlement.load_settlement(spark, tenant, raw.filter(open_), "0", "2026-01-01 00:00:00", bad)
    settlement.load_settlement(spark, tenant, raw.filter(~open_), "1", "2026-01-01 00:00:00", bad)
    again = raw.filter(open_ & (F.col("Traffic Direction") != "VR"))
    settlement.load_settlement(spark, tenant, again, "0", "2026-01-02 00:00:00", bad)
    names = [f.name for f in schema_of(SETTLEMENT_DDL).fields]
    return spark.table(table_spec("settlement", "gold").full_name(tenant)).select(*names)


@query
def archived_rows(spark, folder):
    """Orders by month in the archive, after months were retired twice with late rows in between."""
    tenant = _own_tenant("retire")
    tables.create_schemas(spark, tenant)
    live, archive = f"{tenant}_gold.orders", f"{tenant}_gold.orders_archive"
    for name in (live, archive):
        tables.create_table(spark, name, "o_orderkey bigint, o_totalprice double, month date", ("month",))
    orders = derived.table(spark, folder, "orders")
    monthly = orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("month"))
    late = F.col("o_orderkey") % 10 == 0
    today = _last(orders, F.to_date("o_orderdate"))
    for part in (monthly.filter(~late), monthly.filter(late)):
        tables.append_table(part, live)
        tables.retire_partitions(spark, live, archive, "month", today)
    return spark.table(archive).groupBy("month").agg(F.count("*").alias("row_count"))


# Dimensions


def _dimension_query(name: str) -> Query:
    def build(spark, folder):
        return dims.build_dimension(_bronze(spark, folder), USAGE_DIMENSIONS[name])

    build.__name__ = name
    return build


for _name in USAGE_DIMENSIONS:
    query(_dimension_query(_name))


@query
def dimension_members(spark, folder):
    """Members of all bounded usage dimensions, built together."""
    members = dims.all_members(_bronze(spark, folder), usage.BOUNDED)
    return members.groupBy("dimension").agg(
        F.count("*").alias("members"), F.count("attribute").alias("with_attribute"), F.min("label").alias("first_label")
    )


@query
def dim_forecast_actual(spark, folder):
    return dims.forecast_actual_dimension(_forecast_bronze(spark, folder))


@query
def dim_partner(spark, folder):
    return dims.partner_dimension(_forecast_bronze(spark, folder), RUN_AT).drop("created_at", "updated_at")


@query
def dim_agreement(spark, folder):
    return dims.agreement_dimension(_forecast_bronze(spark, folder), RUN_AT).drop("created_at", "updated_at")


@query
def dim_upsert(spark, folder):
    """Subscribers not yet known to a table built from the finished orders."""
    bronze = _bronze(spark, folder)
    subscriber = USAGE_DIMENSIONS["dim_imsi"]
    existing = dims.build_dimension(bronze.filter(F.col("event_type_id") == "F"), subscriber)
    return dims.new_members(dims.build_dimension(bronze, subscriber), existing, subscriber.key)


@query
def dim_upsert_stored(spark, folder):
    """A bucketed subscriber table built from the finished orders, some profiles unknown, after all orders came in."""
    tenant, subscriber = _own_tenant("upsert"), USAGE_DIMENSIONS["dim_imsi"]
    spec = DIMENSION_TABLES[subscriber.table]
    tables.create_schemas(spark, tenant)
    name = tables.create_from_spec(spark, tenant, spec)
    bronze = _bronze(spark, folder)
    known = dims.dimension_members(bronze.filter(F.col("event_type_id") == "F"), subscriber)
    unknown = F.col("label").like("%7")
    known = known.withColumn("attribute", F.when(~unknown, F.col("attribute")))
    loads = (dims.from_members(known, subscriber), dims.build_dimension(bronze, subscriber))
    days = [f"2026-01-0{day} 00:00:00" for day in (1, 2)]
    for members, day in zip(loads, days, strict=True):
        upserts.upsert(members, name, subscriber.key, day)
    last = F.lit(days[1]).cast("timestamp")
    outcome = F.when(F.col("created_at") == last, "inserted").when(F.col("updated_at") == last, "filled").otherwise("kept")
    return spark.table(name).withColumn("outcome", outcome).drop("created_at", "updated_at", upserts.BUCKET)


# Facts and marts


@query
def usage_fact(spark, folder):
    return facts.usage_fact(_bronze(spark, folder))


@query
def gold_daily(spark, folder):
    return usage.usage_daily(_bronze(spark, folder))


@query
def gold_monthly(spark, folder):
    bronze = _bronze(spark, folder)
    dimensions = usage.staged_dimensions(bronze)
    return marts.usage_monthly(usage.usage_daily(bronze, dimensions, placed=True), dimensions)


@query
def forecast_fact(spark, folder):
    return forecast.forecast_fact(_forecast_bronze(spark, folder), RUN_AT, written=True)


@query
def documented_forecast_fact(spark, folder):
    return facts.keyed_forecast_fact(_forecast_bronze(spark, folder))


@query
def by_client_date(spark, folder):
    return marts.forecast_by_client_date(_forecast_fact(spark, folder))


@query
def by_service_direction(spark, folder):
    return marts.forecast_by_service_direction(_forecast_fact(spark, folder))


@query
def variance(spark, folder):
    return marts.forecast_variance(_forecast_fact(spark, folder))


@query
def variance_outer_join(spark, folder):
    return marts.forecast_variance_by_join(_forecast_fact(spark, folder))


@query
def forecast_monthly(spark, folder):
    return marts.forecast_monthly(_forecast_fact(spark, folder))


@query
def settlement_gold(spark, folder):
    return settlement.settlement_gold(_settlement_raw(spark, folder))


@query
def settlement_invalid(spark, folder):
    _, invalid = settlement.split_settlement(_settlement(spark, folder))
    return invalid.select("row_id", "home_pmn", "partner_pmn", "traffic_period")


# Reports


@query
def variance_rollup(spark, folder):
    return reports.variance_rollup(marts.forecast_variance(_forecast_fact(spark, folder)))


@query
def fa_ratio(spark, folder):
    return reports.fa_ratio(marts.forecast_by_client_date(_forecast_fact(spark, folder)))


@query
def top_clients(spark, folder):
    """Largest clients of the year up to the last period in the data."""
    bronze = _forecast_bronze(spark, folder)
    gold = marts.forecast_by_client_date(forecast.forecast_fact(bronze, RUN_AT))
    clients = (
        rows.not_null(bronze, "client_name", "client_group_name")
        .select("client_name", "client_group_name")
        .distinct()
        .select(
            dims.int_key(F.col("client_name"), F.col("client_group_name")).cast("string").alias("client_key"),
            "client_name",
        )
    )
    return reports.top_clients(gold, clients, _last(bronze, F.to_date("period_start_date")), days=365)


@query
def top_pairs(spark, folder):
    return reports.top_pairs(_bronze(spark, folder))


@query
def pair_activity(spark, folder):
    return reports.pair_activity(_bronze(spark, folder))


@query
def union_counts(spark, folder):
    names = ("orders", "lineitem", "customer", "supplier", "part", "events")
    return reports.union_counts({n: derived.table(spark, folder, n) for n in names})


@query
def inventory(spark, folder):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return quality.table_inventory({f"star.{n}": derived.table(spark, folder, n) for n in names})


@query
def ordered_report(spark, folder):
    return reports.settlement_report(settlement.settlement_gold(_settlement_raw(spark, folder)))


@query
def samples(spark, folder):
    """Three rejected rows, the first in order."""
    _, invalid = split_usage(clean_usage(_usage_raw(spark, folder)))
    return rows.sample(invalid, 3, "call_date", "duration", "volume")


@query
def recent_rows(spark, folder):
    """Usage of the last week in the data."""
    bronze = _bronze(spark, folder)
    dated = bronze.withColumn("day", F.try_to_date("call_date", "yyyy-MM-dd"))
    recent = rows.last_days(dated, "day", 7, _last(dated, F.col("day")))
    return recent.groupBy("day", "service_type_id").agg(
        F.count("*").alias("row_count"), F.sum(F.col("volume").try_cast("decimal(18,6)")).alias("volume")
    )


@query
def indicator_rows(spark, folder):
    """Forecast rows only, counted by service."""
    only = rows.with_indicator(_forecast_bronze(spark, folder), "F")
    return only.groupBy("service_type").agg(F.count("*").alias("row_count"))


# Quality


@query
def range_stats(spark, folder):
    return quality.range_stats(_forecast_bronze(spark, folder), "traffic_volume", "period_start_date")


@query
def null_measures(spark, folder):
    bad = rows.null_measures(_forecast_fact(spark, folder), "traffic_volume", "charged_volume")
    return bad.groupBy("forecast_or_actual_ind").agg(F.count("*").alias("row_count"))


@query
def duplicates(spark, folder):
    """Line keys that occur more than once."""
    return quality.duplicate_keys(derived.table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query
def uniqueness(spark, folder):
    return quality.uniqueness(usage_fact(spark, folder), "client_pmn_key")


@query
def row_uniqueness(spark, folder):
    return quality.row_uniqueness(_bronze(spark, folder))


@query
def orphans(spark, folder):
    """Agreements of forecast rows that no settlement record mentions."""
    fact = forecast.forecast_fact(_forecast_bronze(spark, folder), RUN_AT)
    known = dims.agreement_dimension(_settlement(spark, folder), RUN_AT)
    return quality.orphans(fact, "iot_agreement_id", known, "iot_agreement_id")


@query
def orphan_count(spark, folder):
    bronze = _forecast_bronze(spark, folder)
    fact = forecast.forecast_fact(bronze, RUN_AT)
    return quality.orphan_count(fact, "iot_agreement_id", dims.agreement_dimension(bronze, RUN_AT), "iot_agreement_id")


@query
def reconcile(spark, folder):
    fact = _forecast_fact(spark, folder)
    return quality.reconcile_totals(fact, marts.forecast_by_client_date(fact))


@query
def scalar_total(spark, folder):
    fact = _forecast_fact(spark, folder)
    return quality.total_beside_fact(fact, marts.forecast_by_client_date(fact))


def _quality_report(spark, folder) -> DataFrame:
    bronze, fact = _forecast_bronze(spark, folder), _forecast_fact(spark, folder)
    dimensions = forecast.build_dimensions(bronze, RUN_AT)
    gold = {domain: build(fact) for domain, build in forecast.GOLD.items()}
    gold["forecast_monthly"] = marts.forecast_monthly(fact)
    return forecast.quality_report(bronze, dimensions, fact, gold)


@query
def quality_report(spark, folder):
    return _quality_report(spark, folder)


@query
def quality_summary(spark, folder):
    return quality.validation_summary(_quality_report(spark, folder))


@query
def required_columns(spark, folder):
    """Mandatory settlement columns: present or missing, and how many rows fill them."""
    return quality.column_coverage(_settlement(spark, folder), SETTLEMENT_REQUIRED_COLUMNS)


def _cell_issues(spark, folder) -> DataFrame:
    return quality.cell_issues(
        _settlement(spark, folder), "row_id", settlement.date_columns(), settlement.decimal_columns()
    )


@query
def csv_issues(spark, folder):
    """Every cell that is no date or number."""
    return _cell_issues(spark, folder)


@query
def first_issues(spark, folder):
    return quality.first_issues(_cell_issues(spark, folder), "row_id")


@query
def issue_counts(spark, folder):
    return quality.issue_counts(_cell_issues(spark, folder))


@query
def strict_date_issues(spark, folder):
    """Cells of the agreement dates that are not ISO dates, by column."""
    strict = quality.cell_issues(
        _settlement(spark, folder), "row_id", ["agreement_start_date", "agreement_end_date"], [], rows.DATE_TEXT
    )
    return quality.issue_counts(strict)


@query
def missing_required(spark, folder):
    return quality.missing_required_rows(_settlement(spark, folder), "row_id", "home_pmn")


@query
def repair_stats(spark, folder):
    return quality.repair_stats(_settlement(spark, folder), settlement.decimal_columns())


@query
def empty_rows(spark, folder):
    return quality.empty_row_count(_usage_raw(spark, folder))


@query
def daily_counts(spark, folder):
    return quality.rows_per_day(_events(spark, folder), F.col("ts"))


@query
def freshness(spark, folder):
    """Judged half a day after the last event."""
    events = _events(spark, folder)
    return quality.freshness(events, "ts", _half_day_after(events))


def _half_day_after(events: DataFrame) -> str:
    return _last(events, F.col("ts").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS"))


@query
def alerts(spark, folder):
    """Weekly deviation, days without an event type, and stale loads."""
    events = _events(spark, folder)
    # One row per kind of event: a handful, as many as the sources define.
    kinds = [r[0] for r in events.select("event_type").distinct().orderBy("event_type").collect()]
    return quality.completeness_alerts(events, "ts", "event_type", [*kinds, "refund"], _half_day_after(events))


@query
def stored_alerts(spark, folder):
    """The same alerts from stored counts, after three batches of which one was first counted with fewer rows."""
    events = _events(spark, folder)
    tenant = _own_tenant("counts")
    tables.create_schemas(spark, tenant)
    name = f"{tenant}_silver.event_counts"
    counts.create_counts(spark, name)
    third = F.pmod("user_id", F.lit(3))
    for batch, part in (("0", third == 0), ("1", (third == 1) & (F.col("value") > 50)), ("2", third == 2), ("1", third == 1)):
        counts.update_counts(spark, name, events.filter(part), batch, "ts", "event_type", compact_at=2)
    stored = counts.stored_counts(spark, name)
    kinds = [r[0] for r in stored.select("category").distinct().orderBy("category").collect()]
    return counts.alerts(stored, [*kinds, "refund"], _half_day_after(events))


@query
def forecast_alerts(spark, folder):
    """Months, from first to last, without rows of an indicator; budgets (B) are due as well."""
    bronze = _forecast_bronze(spark, folder)
    return quality.missing_days(
        bronze, F.col("period_start_date"), F.col("forecast_or_actual_ind"), ["F", "A", "B", "X"], "1 MONTH"
    )


# Tables


@query
def schema_evolution(spark, folder):
    """A column added, one renamed, one dropped, one widened."""
    orders = derived.table(spark, folder, "orders")
    wider = tables.with_type(orders.withColumn("o_priority", F.substring("o_orderpriority", 1, 1)), "o_priority", "bigint")
    renamed = tables.with_columns_renamed(wider, {"o_totalprice": "gross_amount"})
    added = tables.with_column_added(renamed, "settled_on", "date")
    return tables.without_columns(added, "o_orderpriority", "o_orderdate")


@query
def retired_rows(spark, folder):
    """Orders older than two years at the last order, by year."""
    orders = derived.table(spark, folder, "orders")
    _, old = tables.retired(orders, "o_orderdate", _last(orders, F.to_date("o_orderdate")))
    return old.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("row_count"))


@query
def catalog_round_trip(spark, folder):
    """Orders in a table that was renamed, widened and moved between layers: what is listed, its columns, and its rows."""
    tenant = _own_tenant("catalog")
    tables.create_schemas(spark, tenant)
    bronze, silver = f"{tenant}_bronze.orders_raw", f"{tenant}_silver.orders"
    ddl = "o_orderkey bigint, o_totalprice double, o_orderpriority string, o_orderstatus string"
    for name in (bronze, f"{tenant}_gold.unused"):
        tables.create_table(spark, name, ddl, ("o_orderstatus",))
    tables.append_table(derived.table(spark, folder, "orders"), bronze)
    tables.add_column(spark, bronze, "settled_on", "date")
    tables.rename_column(spark, bronze, "o_totalprice", "gross")
    tables.update_column_type(spark, bronze, "gross", "decimal(18,2)")
    tables.drop_column(spark, bronze, "o_orderpriority")
    tables.rename_table(spark, bronze, f"{tenant}_bronze.orders_kept")
    tables.rename_table(spark, f"{tenant}_bronze.orders_kept", silver)
    tables.drop_table(spark, f"{tenant}_gold.unused")
    stored = shape.stamp(read_table(spark, tenant, "silver", "orders"), RUN_AT)
    layer = F.element_at(F.split("table_schema", "_"), -1)
    listed = list_tables(spark, tenant).select(F.lit("table").alias("kind"), F.concat_ws(".", layer, "table_name").alias("name"))
    known = [(n, str(spark.catalog.tableExists(n)).lower()) for n in (bronze, silver)]
    exists = spark.createDataFrame(known, "name string, value string").select(
        F.lit("exists").alias("kind"), F.element_at(F.split("name", "[.]"), -1).alias("name"), "value"
    )
    differing = shape.missing_and_extra(stored, ["o_orderkey", "o_totalprice", "o_orderstatus"])
    columns = differing.select("problem", "column_name").toDF("kind", "name")
    by_status = stored.groupBy("o_orderstatus", "updated_at").agg(F.count("*").alias("n"), F.sum("gross").alias("gross"))
    held = by_status.select(
        F.lit("rows").alias("kind"), F.col("o_orderstatus").alias("name"),
        F.concat_ws(" ", F.col("n").cast("string"), F.col("gross").cast("string"), F.date_format("updated_at", "yyyy-MM-dd")).alias("value"),
    )
    return held.unionByName(exists).unionByName(listed, allowMissingColumns=True).unionByName(columns, allowMissingColumns=True)


@query
def quarantine_round_trip(spark, folder):
    """Rejected usage records as read back from both forms of quarantine, and settlement records from theirs."""
    path, tenant = F.col(SOURCE_PATH), F.lit("north")
    raw = _pathed(_usage_raw(spark, folder), "Bronze/Traffic")
    rejected = split_usage(clean_usage(raw))[1]
    rejected = shape.add_audit_columns(rejected, path, tenant=tenant, layer="bronze", domain="traffic", ingested_at=RUN_AT)
    columnar, delimited = scratch_path(spark, "quarantine"), scratch_path(spark, "quarantine")
    for _ in range(2):  # a repeat replaces the day
        tables.quarantine_parquet(rejected, columnar)
    _, unfit = settlement.split_settlement(_settlement(spark, folder))
    tables.quarantine_csv(unfit, delimited)
    usage_back = spark.read.parquet(columnar).select("_ingest_date", F.col("service_type_id").alias("kind"), "duration")
    back = spark.read.options(header=True, escape='"').csv(delimited)
    settled_back = back.select(F.lit(None).cast("date").alias("_ingest_date"), F.col("event_type").alias("kind"), F.col("row_id").alias("duration"))
    both = usage_back.withColumn("origin", F.lit("usage")).unionByName(settled_back.withColumn("origin", F.lit("settlement")))
    return both.groupBy("origin", F.col("_ingest_date").cast("string").alias("day"), "kind").agg(
        F.count("*").alias("row_count"), F.count("duration").alias("filled"), F.max("duration").alias("last")
    )


@query
def multi_line_rows(spark, folder):
    """Part descriptions over several lines, with quotes and delimiters in them, written and read back."""
    part = derived.table(spark, folder, "part")
    note = F.concat(F.lit('"'), "p_brand", F.lit('";\n'), "p_type", F.lit("\n\n"), F.col("p_size").cast("string"))
    root = scratch_path(spark, "notes")
    part.select("p_partkey", note.alias("note"), "p_name").write.options(
        header=True, sep=";", escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(root)
    landed = read_delimited(spark, _files_under(spark, root), multi_line=True)
    return landed.select(F.col("p_partkey").cast("long"), "note", "p_name")


@query
def blank_keys(spark, folder):
    """Rows whose partner is blank or absent, as the required-value rule sees them."""
    cleaned = clean_usage(_usage_raw(spark, folder))
    return cleaned.groupBy(is_blank(F.col("partner_pmn")).alias("blank_partner")).agg(F.count("*").alias("row_count"))


def entry(spark: SparkSession, folder: str) -> DataFrame:
    """Raw usage to monthly totals: the whole flow in one query."""
    return gold_monthly(spark, folder)

