"""Settlement files straight to gold: required values checked, dates and numbers repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from tierline.model import (
    SETTLEMENT_DDL,
    SETTLEMENT_HEADERS,
    SETTLEMENT_REQUIRED_VALUES,
    schema_of,
    table_spec,
)
from tierline.operators import tables
from tierline.operators.rows import filter_empty_rows, required_violation, split
from tierline.operators.shape import (
    add_audit_columns,
    align_typed,
    cast_all_to_string,
    normalize_columns,
    rename_headers,
)
from tierline.sources.files import SOURCE, SOURCE_COLUMNS, SOURCE_PATH, SOURCE_TEXT, tenant_of


def date_columns() -> list[str]:
    return [f.name for f in schema_of(SETTLEMENT_DDL).fields if isinstance(f.dataType, DateType)]


def decimal_columns() -> list[str]:
    return [f.name for f in schema_of(SETTLEMENT_DDL).fields if isinstance(f.dataType, DecimalType)]


def clean_settlement(raw: DataFrame) -> DataFrame:
    named = normalize_columns(rename_headers(raw, SETTLEMENT_HEADERS), keep=SOURCE)
    return cast_all_to_string(filter_empty_rows(named, ignore=SOURCE))


def split_settlement(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): required values are there, and the row has the cells of its header."""
    violation = required_violation(cleaned.columns, SETTLEMENT_REQUIRED_VALUES, SOURCE_COLUMNS)
    if SOURCE_TEXT in cleaned.columns:
        violation = violation | F.col(SOURCE_TEXT).isNotNull()
    return split(cleaned, violation)


def settlement_gold(raw: DataFrame) -> DataFrame:
    valid, _ = split_settlement(clean_settlement(raw))
    return align_typed(valid, schema_of(SETTLEMENT_DDL))


def load_settlement(
    spark: SparkSession, tenant: str, raw: DataFrame, batch: str, loaded_at: str, quarantine: str
) -> None:
    """One batch of raw rows (with their file path); a repeat, also on another day, replaces what the batch wrote."""
    tables.create_schemas(spark, tenant)
    name = tables.create_from_spec(spark, tenant, table_spec("settlement", "gold"))
    path = F.col(SOURCE_PATH)
    audited = add_audit_columns(
        clean_settlement(raw), path, tenant=tenant_of(path), layer="gold", domain="settlement", ingested_at=loaded_at
    )
    valid, invalid = split_settlement(audited)
    lineage = [c for c in audited.columns if c.startswith("_") and c not in SOURCE]
    gold = align_typed(valid, schema_of(SETTLEMENT_DDL), *lineage)
    tables.replace_batch(gold.withColumn("_batch", F.lit(batch)), name, batch)
    tables.quarantine_csv(invalid, f"{quarantine}/_batch={batch}")
